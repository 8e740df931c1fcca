"""Toxicity: a convolutional text classifier trained in numpy, with thresholds by language.

Words are hashed (the word and its first 4 to 7 letters) into a table of embeddings; a word's vector
is the sum of its entries.  Filters of widths 1, 2 and 3 slide over the words of a whole text, and
filters of width WIDE, whose places share their weights, see how dense words of a kind are; each
filter's maximum over the text goes through a rectifier into a logistic unit.  Entries met in fewer
than LEAST_DOCS fitted texts stay zero, so a rare word counts by its stems only.  All of it is trained
by gradients in numpy on the driver, on a bounded sample of labelled rows: at most FIT_TOXIC toxic
and FIT_CLEAN other rows of at most FIT_CHARS characters each, chosen by a digest of their id.  The
trained arrays (a few MB, fixed by the parameters) are broadcast and every row is scored.

A score uses the text alone.  For the decision ``rejected``, each language's threshold is the one
with the best F1 on all labelled rows outside the held-out fold that the fit did not use, whatever
their number and length; languages with fewer than LEAST_TOXIC toxic rows among them use 0.5, to
which the fit moves the best cut over all languages.  Those rows are scored in Spark and counted by
language, label and bin of the score (STEP wide in log-odds), so a cut is exact to one bin and the
driver holds at most a few thousand counts for each language.  Every text is scored once: the rows'
log-odds are stored, the cuts come from that table, and the decisions are expressions over it.
Rows that the fit used are counted apart: the others stand for them too, each weighed by rows of its kind (label, short or long) over
those of them that the fit did not use, so the shares of the kinds are those of the whole table.

A word's filter responses do not depend on its neighbours, so each worker keeps those of words it
has met in a bounded table; a text is scored by adding and comparing rows of that table.

Defined cases: null text counts as empty; a text without words has the score of no evidence; labels
that are null, or whose row has no text, teach nothing; several labels of one id: toxic if any is;
without labels of both kinds all scores are the smoothed share of toxic rows, below 0.5; null ids
are held out; extra columns, whatever their names, are ignored; texts of any length are scored whole
(only the fit passes over those longer than FIT_CHARS).
"""

from __future__ import annotations

import re
import uuid
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hold, map_arrow, new_run, quoted, stored, table

FIT_TOXIC, FIT_CLEAN, FIT_CHARS, LEAST_TOXIC = 2000, 3000, 20000, 20
#: Width of a bin of scores, in log-odds.
STEP = 1 / 64
BUCKETS, DIMS, FILTERS, WIDTHS, WIDE, STEMS = 1 << 16, 16, 6, (1, 2, 3), 40, (4, 5, 6, 7)
EPOCHS, BATCH, RATE, LEAST_DOCS = 6, 32, 0.1, 3
MOST_CACHED = 250_000
FOLDS = 5

LETTERS = re.compile(r"[^\W\d_]+")
#: One response of a word for each place it can have in each filter; one place in the wide filters.
SLOTS = (sum(WIDTHS) + 1) * FILTERS
POOLED = (len(WIDTHS) + 1) * FILTERS


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall((text or "").lower())


def features(word: str) -> list[int]:
    """Table rows of a word: itself and its stems; row 0 stays zero and stands for absent stems."""
    own = 1 + zlib.crc32(word.encode()) % (BUCKETS - 1)
    return [own] + [1 + zlib.crc32(b"%d:" % n + word[:n].encode()) % (BUCKETS - 1) if len(word) > n else 0 for n in STEMS]


@dataclass
class Model:
    embedding: np.ndarray          # BUCKETS x DIMS
    filters: np.ndarray            # DIMS x SLOTS, by width, place, filter
    bias: np.ndarray               # one for each filter
    output: np.ndarray
    offset: float
    cut: float = 0.0               # taken off the log-odds of all languages
    thresholds: dict = field(default_factory=dict)
    default: float = 0.5

    def responses(self, rows: np.ndarray) -> np.ndarray:
        return self.embedding[rows].sum(axis=1) @ self.filters

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled, 0) @ self.output + self.offset

    def threshold(self, lang) -> float:
        return self.thresholds.get(lang, self.default)


def place_columns() -> list[tuple[int, list[slice]]]:
    """For each width, the columns of ``filters`` for its places."""
    out, at = [], 0
    for width in WIDTHS:
        out.append((width, [slice(at + p * FILTERS, at + (p + 1) * FILTERS) for p in range(width)]))
        at += width * FILTERS
    return out


PLACES = place_columns()


def slide(z: np.ndarray, ends: np.ndarray):
    """Width, places and outputs of each group of filters at each start, for texts laid end to end.

    A filter may hang over a text's end (``ends``); the words that are missing there count as zero.
    """
    n = len(z)
    left = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(n)  # words from here to the text's end
    for width, places in PLACES:
        c = z[:, places[0]].copy()
        for p in range(1, width):
            c[:n - p] += z[p:, places[p]] * (left[:n - p] > p)[:, None]
        yield width, places, c
    wide = slice(SLOTS - FILTERS, SLOTS)
    total = np.zeros((n + 1, FILTERS), np.float64)
    np.cumsum(z[:, wide], axis=0, out=total[1:])
    at = np.arange(n)
    yield WIDE, [wide] * WIDE, (total[at + np.minimum(left, WIDE)] - total[at]).astype(np.float32)


def pool(z: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.concatenate([np.maximum.reduceat(c, starts, axis=0) for _, _, c in slide(z, ends)], axis=1)


def gradients(model: Model, rows: np.ndarray, texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray):
    """Gradients of the weighed mean loss of some texts (arrays of word numbers; ``rows``: each word's table rows).

    Returns the table rows met and their gradients, then those of filters, bias, output (with its
    penalty) and offset.
    """
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    words, index = np.unique(np.concatenate(texts), return_inverse=True)
    vectors = model.embedding[rows[words]].sum(axis=1)
    z = (vectors @ model.filters)[index]
    pooled, best, places_of = [], [], []
    for _, places, c in slide(z, ends):
        where = np.array([a + c[a:b].argmax(axis=0) for a, b in zip(starts, ends)])
        best.append(where)
        places_of.append(places)
        pooled.append(np.take_along_axis(c, where, axis=0))
    before = np.concatenate(pooled, axis=1) + model.bias
    hidden = np.maximum(before, 0)
    score = 1 / (1 + np.exp(-np.clip(hidden @ model.output + model.offset, -30, 30)))
    wrong = (score - y) * weight / len(texts)
    g_output = hidden.T @ wrong + 1e-4 * model.output
    g_hidden = (wrong[:, None] * model.output) * (before > 0)
    g_filters = np.zeros_like(model.filters)
    g_words = np.zeros_like(vectors)
    for k, best_k in enumerate(best):
        g = g_hidden[:, k * FILTERS:(k + 1) * FILTERS].astype(np.float32)
        for p, place in enumerate(places_of[k]):
            at_word = best_k + p
            word = index[np.minimum(at_word, len(index) - 1)]
            gi = g * (at_word < ends[:, None])
            g_filters[:, place] += np.einsum("bfd,bf->df", vectors[word], gi)
            np.add.at(g_words, word, gi[:, :, None] * model.filters[:, place].T[None])
    touched = np.nonzero(g_words.any(axis=1))[0]
    g_rows = np.repeat(g_words[touched], rows.shape[1], axis=0)
    cells, back = np.unique(rows[words[touched]].ravel(), return_inverse=True)
    g_cells = np.zeros((len(cells), DIMS), np.float32)
    np.add.at(g_cells, back, g_rows)
    g_cells[cells == 0] = 0
    return cells, g_cells, g_filters, g_hidden.sum(axis=0), g_output, wrong.sum()


def train(texts: list[str], toxic: np.ndarray, prior: float, seed: int = 7) -> Model:
    """Fit the network; ``prior`` is the share of toxic rows where it will be used."""
    rng = np.random.default_rng(seed)
    number: dict[str, int] = {}
    docs = [np.array([number.setdefault(w, len(number)) for w in words_of(t)], np.int64) for t in texts]
    kept = [i for i, d in enumerate(docs) if len(d)]
    y = toxic.astype(np.float64)
    share = min(max(prior, 1e-3), 1 - 1e-3)
    signs = np.where(np.arange(POOLED) % 3 == 2, -1, 1)
    model = Model((rng.standard_normal((BUCKETS, DIMS)) * 0.02).astype(np.float32),
                  (rng.standard_normal((DIMS, SLOTS)) * 0.4).astype(np.float32),
                  np.zeros(POOLED, np.float32), (np.abs(rng.standard_normal(POOLED)) * 0.3 * signs).astype(np.float32),
                  float(np.log(share / (1 - share))))
    if not kept or y[kept].min() == y[kept].max():
        model.output[:] = 0
        model.offset = float(np.log(min(share, 0.4) / (1 - min(share, 0.4))))
        return model
    model.offset = 0.0
    rows = np.array([features(w) for w in number], np.int64)
    met = np.zeros(BUCKETS, np.int64)
    for i in kept:
        met[np.unique(rows[np.unique(docs[i])])] += 1
    met[0] = 0
    model.embedding[met < LEAST_DOCS] = 0
    rows[met[rows] < LEAST_DOCS] = 0
    seen = [np.full_like(a, 1e-4) for a in (model.embedding, model.filters, model.bias, model.output)]
    seen_offset = 1e-4
    weight = np.where(y > 0, len(kept) / (2 * y[kept].sum()), len(kept) / (2 * (1 - y[kept]).sum()))
    for _ in range(EPOCHS):
        order = rng.permutation(kept)
        for at in range(0, len(order), BATCH):
            chosen = order[at:at + BATCH]
            cells, g_cells, g_filters, g_bias, g_output, g_offset = gradients(
                model, rows, [docs[i] for i in chosen], y[chosen], weight[chosen])
            seen[0][cells] += g_cells ** 2
            model.embedding[cells] -= RATE * g_cells / np.sqrt(seen[0][cells])
            for a, s, g in ((model.filters, seen[1], g_filters), (model.bias, seen[2], g_bias),
                            (model.output, seen[3], g_output)):
                s += g ** 2
                a -= (RATE / 2) * g / np.sqrt(s)
            seen_offset += g_offset ** 2
            model.offset -= RATE / 2 * g_offset / np.sqrt(seen_offset)
    # Both kinds weighed alike so far; the odds where the model is used are the prior's.
    model.offset += float(np.log(share / (1 - share)))
    return model


class Scorer:
    """Scores texts with a trained model; keeps the responses of words it has met, within a bound."""

    def __init__(self, model: Model):
        self.model = model
        self.number: dict[str, int] = {}
        self.table = np.zeros((1024, SLOTS), np.float32)

    def _numbers(self, words: list[str]) -> np.ndarray:
        number = self.number
        new = list({w for w in words if w not in number})
        if len(number) + len(new) > MOST_CACHED:
            number.clear()
            new = list(set(words))
        if new:
            first = len(number)
            if first + len(new) > len(self.table):
                self.table = np.concatenate([self.table[:first], np.zeros((max(first, len(new)) + len(new), SLOTS), np.float32)])
            number.update(zip(new, range(first, first + len(new))))
            self.table[first:first + len(new)] = self.model.responses(np.array([features(w) for w in new], np.int64))
        return np.fromiter(map(number.__getitem__, words), np.int64, len(words))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.odds(texts) - self.model.cut, -30, 30)))

    def odds(self, texts: list[str | None]) -> np.ndarray:
        """Log-odds of each text, before the common cut."""
        out = np.zeros((len(texts), POOLED), np.float32)
        group, words, sizes = [], [], []

        def flush():
            if group:
                ends = np.cumsum(sizes)
                numbers = self._numbers(words)
                out[group] = pool(self.table[numbers], ends - sizes, ends) + self.model.bias
                group.clear(), words.clear(), sizes.clear()

        for i, text in enumerate(texts):
            found = words_of(text)
            if found:
                group.append(i), words.extend(found), sizes.append(len(found))
            if len(words) > 50_000:
                flush()
        flush()
        return np.clip(self.model.logits(out).astype(np.float64), -30, 30)


def best_threshold(scores: np.ndarray, toxic: np.ndarray, weight: np.ndarray | None = None, middle: float = 0.5,
                   least: float | None = None) -> float:
    """The cut with the best F1; of equal ones the nearest to ``middle``; ``least``: the cut below all scores."""
    weight = np.ones(len(scores)) if weight is None else weight
    order = np.argsort(-scores, kind="stable")
    s, hit, taken = scores[order], np.cumsum((toxic * weight)[order]), np.cumsum(weight[order])
    f1 = 2 * hit / (taken + hit[-1])
    cut = np.append((s[:-1] + s[1:]) / 2, s[-1] / 2 if least is None else least)
    real = np.append(s[:-1] > s[1:], True)
    good = real & (f1 >= f1[real].max() - 1e-12)
    return float(cut[good][np.argmin(np.abs(cut[good] - middle))])


def best_cut(bins: pd.DataFrame, weights: dict) -> float:
    """The best cut, in log-odds, of rows counted by (toxic, long, bin)."""
    bins = bins.sort_values(["bin", "toxic", "long"])
    middles = (bins["bin"].to_numpy() + 0.5) * STEP
    weight = np.array([n * weights[kind] for n, kind in zip(bins["n"], zip(bins["toxic"], bins["long"]))])
    return best_threshold(middles, bins["toxic"].to_numpy(), weight, 0.0, middles.min() - STEP / 2)


def held_out(id_col):
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def learn(docs: DataFrame, labels: DataFrame, id_col: str) -> tuple[Model, DataFrame, list]:
    """A model trained on labelled rows outside the held-out fold, all known labels there, the ids that it used."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull()).filter(~held_out(F.col(id_col)))
             .groupBy(F.col(id_col).alias("id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
             .withColumn("order", F.md5(F.concat(F.lit("fit:"), F.col("id").cast("string")).cast("binary")))
             .withColumn("calibrate", F.crc32(F.concat(F.lit("cal:"), F.col("id").cast("string")).cast("binary")) % 5 == 0))
    count = known.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).first()
    prior = ((count["t"] or 0) + 1) / (count["n"] + 2)
    # Two ordered limits: bounded whatever the table holds.
    short = docs.filter(F.length("text") <= FIT_CHARS).select(F.col(id_col).alias("id"), "text")
    have = known.filter(~F.col("calibrate")).join(short.select("id").distinct(), "id", "left_semi")
    sample = (have.filter("toxic = 1").orderBy("order").limit(FIT_TOXIC)
              .unionByName(have.filter("toxic = 0").orderBy("order").limit(FIT_CLEAN)))
    learned = (short.join(sample, "id").groupBy("id", "toxic", "order").agg(F.min("text").alias("text"))
               .toPandas().sort_values("order"))
    model = train(learned.text.tolist(), learned.toxic.to_numpy(), prior)
    return model, known.select("id", "toxic"), learned.id.tolist()


def calibrate(model: Model, scored: DataFrame, known: DataFrame, used: list) -> None:
    """Set the common cut and the thresholds by all known rows but those with the ids ``used``.

    ``scored``: id, lang, long (null: no text) and odds of all rows.  Scores meet the labels, not
    texts: no text is shuffled.
    """
    if not model.output.any():
        return
    spark = scored.sparkSession
    binned = (scored.filter("long IS NOT NULL AND id IS NOT NULL").filter(~held_out(F.col("id")))
              .select("id", "lang", "long", F.floor(F.col("odds") / STEP).cast("int").alias("bin")))
    fitted = spark.createDataFrame([(i,) for i in used], T.StructType([T.StructField("id", known.schema["id"].dataType)]))
    bins = stored(binned.join(known, "id").join(F.broadcast(fitted.withColumn("fitted", F.lit(1))), "id", "left")
                  .groupBy("lang", "toxic", "long", F.coalesce("fitted", F.lit(0)).alias("fitted"), "bin")
                  .agg(F.count(F.lit(1)).alias("n")), f"{new_run(spark, 'toxicity')}/bins")
    kinds = bins.groupBy("toxic", "long").agg(F.sum("n").alias("all"), F.sum(F.expr("n * (1 - fitted)")).alias("unused")).collect()
    weights = {(r["toxic"], r["long"]): r["all"] / r["unused"] for r in kinds if r["unused"]}
    free = bins.filter("fitted = 0")
    whole = free.groupBy("toxic", "long", "bin").agg(F.sum("n").alias("n")).toPandas()
    if LEAST_TOXIC <= whole.n[whole.toxic == 1].sum() < whole.n.sum():
        # Move all scores so that the best cut over all languages is 0.5.
        model.cut = min(max(best_cut(whole, weights), -13.8), 13.8)
    enough = (free.filter("lang IS NOT NULL").groupBy("lang").agg(F.sum(F.expr("n * toxic")).alias("t"), F.sum("n").alias("n"))
              .filter((F.col("t") >= LEAST_TOXIC) & (F.col("t") < F.col("n"))).select("lang"))
    for name, own in free.join(enough, "lang").select("lang", "toxic", "long", "bin", "n").toPandas().groupby("lang"):
        model.thresholds[name] = float(1 / (1 + np.exp(model.cut - best_cut(own, weights))))


_SCORERS: dict[str, Scorer] = {}


def with_odds(rows: DataFrame, model: Model, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of each row and ``odds``, the log-odds of its column ``text`` before the common cut."""
    shipped, key = rows.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    sent = rows.select(*keep, *[text] * (text not in keep))
    place = sent.columns.index(text)

    def run(batches):
        hold("toxicity", _SCORERS.clear)
        if key not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[key] = Scorer(shipped.value)
        scorer = _SCORERS[key]
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                odds = scorer.odds(part.column(place).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], pa.array(odds)], [*keep, "odds"])

    types = dict(sent.dtypes)
    return map_arrow(sent, run, "".join(f"`{c}` {types[c]}, " for c in keep) + "odds double")


def decided(scored: DataFrame, model: Model, lang: str) -> DataFrame:
    """``scored`` with score, predicted, threshold and rejected instead of its odds."""
    odds = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("odds") - F.lit(float(model.cut))))
    cut = F.lit(float(model.default))
    if model.thresholds:
        cells = [F.lit(x) for item in model.thresholds.items() for x in item]
        cut = F.coalesce(F.try_element_at(F.create_map(*cells), F.col(lang)), cut)
    return (scored.withColumn("score", 1 / (1 + F.exp(-odds))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
            .withColumn("threshold", cut).withColumn("rejected", F.col("score") >= F.col("threshold")).drop("odds"))


def plain_rows(docs: DataFrame, id_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), "text", "lang", (F.length("text") > FIT_CHARS).cast("int").alias("long"))


def fit_and_score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> tuple[Model, DataFrame]:
    """The calibrated model, and id, score, predicted, threshold, rejected for each row: every text is scored once."""
    model, known, used = learn(docs, labels, id_col)
    scored = stored(with_odds(plain_rows(docs, id_col), model, "text", ["id", "lang", "long"]),
                    f"{new_run(docs.sparkSession, 'toxicity')}/odds")
    calibrate(model, scored, known, used)
    return model, decided(scored, model, "lang").drop("lang", "long").withColumnRenamed("id", id_col)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> Model:
    """Train and calibrate on labelled rows outside the held-out fold."""
    return fit_and_score(docs, labels, id_col)[0]


def score_rows(docs: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """id, score, predicted, threshold, rejected for each row, by a model fitted before."""
    scored = with_odds(plain_rows(docs, id_col), model, "text", ["id", "lang"])
    return decided(scored, model, "lang").drop("lang").withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows whose score stays below their language's threshold, with all their columns.

    Rows are stored with their odds, since ids may be null or repeated: no row has to find its score.
    """
    model, known, used = learn(docs, labels, id_col)
    # Columns by place, whatever their names.
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[quoted(c).alias(n) for c, n in names.items()], (F.length("text") > FIT_CHARS).cast("int").alias("long"))
    scored = stored(with_odds(rows, model, names["text"], [*names.values(), "long"]),
                    f"{new_run(docs.sparkSession, 'toxicity')}/rows")
    calibrate(model, scored.select(F.col(names[id_col]).alias("id"), F.col(names["lang"]).alias("lang"), "long", "odds"), known, used)
    kept = decided(scored, model, names["lang"]).filter(~F.col("rejected"))
    return kept.select(*[F.col(n).alias(c) for c, n in names.items()])


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, scored = fit_and_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return (scored.withColumn("held_out", held_out(F.col("doc_id")))
            .select("doc_id", "held_out", "score", "predicted", "threshold", "rejected"))

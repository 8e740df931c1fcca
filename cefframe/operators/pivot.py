"""Label pivot (``pivotFields``): ``k=v kLabel=Name`` becomes column ``Name``.

Per row there are small arrays, last pair of the line first.  Labels are resolved once per line into
three dense arrays: the column each one names, the place of its pair and the type code of its key;
keys that a label uses up are blanked.  A column then makes two searches, by its name among the named
columns and among the keys left, which gives it a place in the array of pairs or none.  The type of a
key is known from the dictionary, so only labels need their source's type at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions import tokens as TK
from ..functions import values as V
from ..options import CefOptions

# --- fixed values (the suffix of label keys, the message of a type clash) ---
LABEL_SUFFIX = "Label"
TYPE_CLASH_MESSAGE = "An error occurred parsing the record."
# --- end of fixed values ---

# Type codes of source keys (0 = string / not in the dictionary).
_TYPES = (T.FloatType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampType())


def type_code(dt: T.DataType) -> int | None:
    if isinstance(dt, T.StringType):
        return 0
    for i, t in enumerate(_TYPES, start=1):
        if t == dt:
            return i
    return None


def label_column_name(label: Column) -> Column:
    """Label text -> column name, with the ``_1`` suffix on header clashes."""
    return F.when(F.lower(label).isin([h.lower() for h in S.HEADER_FIELDS]),
                  F.concat(label, F.lit(S.CONFLICT_SUFFIX))).otherwise(label)


def _src_code(src: Column) -> Column:
    expr = None
    for i, dt in enumerate(_TYPES, start=1):
        cond = src.isin(S.keys_of_type(dt))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(0))


def _nonnull_by_code(raw: Column, code: Column) -> Column:
    expr = None
    for i, dt in enumerate(_TYPES, start=1):
        val = V.convert(raw, dt).isNotNull()
        expr = F.when(code == i, val) if expr is None else expr.when(code == i, val)
    return expr.otherwise(raw.isNotNull())


def label_arrays(df: DataFrame, m: Column, keep: list[Column], null_value: str, prefix: str,
                 positions: bool = False) -> DataFrame:
    """``k`` (keys), ``m`` (whole pairs), ``lk`` and ``lv`` (keys and values of labels), last pair first.

    Also ``p``, places in the line, if asked.  A key that is repeated keeps its last pair.  Each stage is a Project over column references, so an
    array is built once per row; values are cut out later, for the columns that are selected.
    """
    k, pairs, lk, lv, p = (prefix + x for x in ("k", "m", "lk", "lv", "p"))
    place = [F.reverse(F.sequence(F.lit(0), F.greatest(F.size(m) - 1, F.lit(0)))).alias(p)] if positions else []
    d = df.select(*keep, F.reverse(TK.match_keys(m)).alias(k), F.reverse(m).alias(pairs), *place)
    arrays = [k, pairs, *([p] if positions else [])]
    # The quadratic filter only runs for lines that repeat a key.
    single = F.size(F.array_distinct(k)) == F.size(k)

    def last_only(name: str) -> Column:
        first = F.filter(F.col(name), lambda x, i: F.array_position(F.col(k), F.get(F.col(k), i)).cast("int") == i + 1)
        return F.when(single, F.col(name)).otherwise(first)

    d = d.select(*keep, *[last_only(x).alias(x) for x in arrays])
    d = d.select(*keep, *arrays, F.filter(k, lambda x: x.endswith(LABEL_SUFFIX) & (
        F.array_position(F.col(k), base_key(x)) > 0)).alias(lk))
    value = F.transform(lk, lambda x: TK.null_token(TK.java_trim(TK.match_text(
        F.get(F.col(pairs), F.array_position(F.col(k), x).cast("int") - 1))), null_value))
    return d.select(*keep, *arrays, lk, value.alias(lv))


def base_key(label: Column) -> Column:
    return F.substr(label, F.lit(1), F.length(label) - len(LABEL_SUFFIX))


def _label_of(key: Column, lk: str, lv: str) -> Column:
    """The label of a key, null if it has none."""
    return F.get(F.col(lv), F.array_position(F.col(lk), F.concat(key, F.lit(LABEL_SUFFIX))).cast("int") - 1)


def label_slots(df: DataFrame, m: Column, keep: list[Column], fields: list[T.StructField], null_value: str,
                prefix: str, blanked: bool) -> DataFrame:
    """The dense arrays of each line: ``ln``, ``lp``, ``lc`` (labels: column, place from 1, type code),
    ``k`` (keys) with ``lu`` (those that a label uses up), and ``m`` (whole pairs).

    ``blanked``: the keys that are used up are null in ``k``, and the others are named as columns are.
    Each stage is a Project over column references, so an array is built once per row.
    """
    k, pairs, lk, ls, ln, lp, lc, lu = (prefix + x for x in ("k", "m", "lk", "ls", "ln", "lp", "lc", "lu"))
    d = df.select(*keep, F.reverse(TK.match_keys(m)).alias(k), F.reverse(m).alias(pairs))
    paired = F.filter(k, lambda x: x.endswith(LABEL_SUFFIX) & (F.array_position(F.col(k), base_key(x)) > 0))
    d = d.select(*keep, k, pairs, paired.alias(lk))

    def resolved(key: Column) -> Column:
        name = TK.null_token(TK.java_trim(TK.match_text(
            F.get(F.col(pairs), F.array_position(F.col(k), key).cast("int") - 1))), null_value)
        base = base_key(key)
        return F.struct(label_column_name(name).alias("name"), base.alias("base"), key.alias("key"),
                        F.array_position(F.col(k), base).cast("int").alias("place"))

    labels = F.filter(F.transform(lk, resolved), lambda x: x["name"].isNotNull())
    d = d.select(*keep, k, pairs, labels.alias(ls))
    used = F.concat(F.col(ls)["key"], F.col(ls)["base"])
    keys = F.transform(k, lambda x: F.when(~F.array_contains(used, x), label_column_name(x))) if blanked else F.col(k)
    return d.select(*keep, keys.alias(k), pairs, F.col(ls)["name"].alias(ln), F.col(ls)["place"].alias(lp),
                    F.transform(ls, lambda x: _src_code(x["base"])).alias(lc), used.alias(lu))


def other_pairs(names: Column, pairs: Column, fields: list[T.StructField], opts: CefOptions) -> Column:
    """Map of the values whose column is not among ``fields``, by name; null if there are none.

    Of equal names the first counts; null names give no entry.
    """
    known = F.array(*[F.lit(f.name) for f in fields]) if fields else F.array().cast("array<string>")
    entries = F.arrays_zip(names.alias("n"), pairs.alias("m"))
    left = F.filter(entries, lambda x, i: x["n"].isNotNull() & ~F.array_contains(known, x["n"])
                    & (F.array_position(names, x["n"]) == i + 1))

    def entry(x: Column) -> Column:
        value = TK.clean_value(TK.match_text(x["m"]), opts.null_value)
        return F.struct(x["n"], TK.unescape_extension(value) if opts.unescape else value)

    any_left = F.size(F.array_except(F.array_compact(names), known)) > 0
    return F.when(any_left, F.map_from_entries(F.transform(left, entry)))


def pivoted_columns(df: DataFrame, m: Column, fields: list[T.StructField], keep: list[Column], opts: CefOptions,
                    prefix: str, rest: bool = False) -> tuple[DataFrame, Column]:
    """Typed columns ``t0``, ``t1``, ... (and ``rest``); and a flag: the line has a value of the wrong type."""
    k, pairs, ln, lp, lc, lu, clash = (prefix + x for x in ("k", "m", "ln", "lp", "lc", "lu", "clash"))
    # Most schemas find their columns by the keys as they stand, without a pass over them.
    blanked = rest or any(f.name.endswith(S.CONFLICT_SUFFIX) for f in fields)
    step = label_slots(df, m, keep, fields, opts.null_value, prefix, blanked)
    want = [type_code(f.dataType) for f in fields]
    plain = [type_code(S.key_type(f.name)) for f in fields]

    def text(place: Column) -> Column:
        value = TK.clean_value(TK.match_text(F.get(F.col(pairs), place - 1)), opts.null_value)
        return TK.unescape_extension(value) if opts.unescape else value

    def at(array: str, name: str) -> Column:
        return F.array_position(F.col(array), F.lit(name)).cast("int")

    def by_own_key(name: str) -> Column:
        place = F.nullif(at(k, name), F.lit(0))
        return place if blanked else F.when(~F.array_contains(lu, F.lit(name)), place)

    # A label whose key is not of its column's type: rarely any, so values are only read for those.
    names = F.array(*[F.lit(f.name) for f in fields]) if fields else F.array().cast("array<string>")
    wanted = F.array(*[F.lit(w).cast("int") for w in want]) if fields else F.array().cast("array<int>")
    label = F.arrays_zip(F.col(ln).alias("n"), F.col(lp).alias("p"), F.col(lc).alias("c"))
    odd = F.filter(label, lambda x, i: (F.get(wanted, F.array_position(names, x["n"]).cast("int") - 1) != x["c"])
                   & (F.array_position(F.col(ln), x["n"]) == i + 1))
    wrong = F.exists(odd, lambda x: _nonnull_by_code(text(x["p"]), x["c"]))
    # A key whose own type is not its column's (in a declared schema): known from the schema.
    for f, w, own in zip(fields, want, plain):
        if w is not None and w != own:
            found = F.when(at(ln, f.name) == 0, by_own_key(f.name))
            wrong = wrong | F.coalesce(_nonnull_by_code(text(found), F.lit(own)), F.lit(False))
    cut = []
    for i, (f, w, own) in enumerate(zip(fields, want, plain)):
        by_label = at(ln, f.name)
        place = F.get(F.col(lp), by_label - 1)
        if w is not None:
            place = F.when(F.get(F.col(lc), by_label - 1) == w, place)
        by_key = by_own_key(f.name) if w in (None, own) else F.lit(None).cast("int")
        chosen = F.when(by_label > 0, place).otherwise(by_key)
        cut.append(TK.match_text(F.get(F.col(pairs), chosen - 1)).alias(f"{prefix}r{i}"))
    others = []
    if rest:
        # Labels first, then the keys that are left, as columns look themselves up.
        step = step.withColumn(f"{prefix}n", F.concat(F.col(ln), F.col(k)))
        step = step.withColumn(f"{prefix}v", F.concat(F.transform(lp, lambda x: F.get(F.col(pairs), x - 1)), F.col(pairs)))
        cut.append(other_pairs(F.col(f"{prefix}n"), F.col(f"{prefix}v"), fields, opts).alias(f"{prefix}rest"))
        others.append(F.col(f"{prefix}rest"))
    step = step.select(*keep, *cut, F.coalesce(wrong, F.lit(False)).alias(clash))
    cleaned = []
    for i in range(len(fields)):
        value = TK.clean_value(F.col(f"{prefix}r{i}"), opts.null_value)
        cleaned.append((TK.unescape_extension(value) if opts.unescape else value).alias(f"{prefix}r{i}"))
    step = step.select(*keep, *cleaned, *others, clash)
    typed = [V.convert(F.col(f"{prefix}r{i}"), f.dataType).alias(f"{prefix}t{i}") for i, f in enumerate(fields)]
    return step.select(*keep, *typed, *others, clash), F.col(clash)


def entries(df: DataFrame, keep: list[Column], prefix: str) -> DataFrame:
    """One row per pair of :func:`label_arrays` that gives a column: ``name``, ``src``, ``p``."""
    k, lk, lv, p = (prefix + x for x in ("k", "lk", "lv", "p"))
    pairs = df.select(*keep, lk, lv, F.explode(F.arrays_zip(F.col(k).alias("k"), F.col(p).alias("p"))).alias("e"))
    key = F.col("e.k")
    label = _label_of(key, lk, lv)
    # The label of a pair is used up, but not if it is itself paired by a label of its own.
    used = F.get(F.col(lv), F.array_position(F.col(lk), key).cast("int") - 1).isNotNull()
    left = pairs.withColumn("label", label).filter(key.isNotNull() & (F.col("label").isNotNull() | ~used))
    return left.select(*keep, label_column_name(F.coalesce("label", "e.k")).alias("name"), key.alias("src"), F.col("e.p").alias("p"))

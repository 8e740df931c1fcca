"""SentencePiece models of the merging kind: exact encoding by backtracking, offset-table decoding.

Such a model merges, again and again, the two neighbours whose joined text is the piece of highest
score (of equals the leftmost).  The encoder reaches the same result without merging the text: one
Aho-Corasick pass finds the longest piece that starts at each character, and pieces are laid down
from the left.  A piece may stand next to its neighbour only if the two are *compatible*, i.e. if
merging their joined characters again ends with the border between them.  Where nothing fits the
encoder steps back and marks the position in a bitfield of failed positions, so it leaves each
position at most once.  The merges of a text, seen at one border only, are the merges of that
border's two pieces, so borders that are compatible pair by pair are what merging the whole gives.

Re-merging two pieces replays the traces of their own merges (score, and the outermost symbols after
each) against each other, until one side is done or a merge across the border comes first.

A character that no piece holds is spelled in byte pieces.  No merge crosses it, nor the border
before a space mark if no piece holds one after another character; texts are cut at these places,
and each Python worker keeps the encodings of short cuts in a bounded table, which only saves work.
The automaton reads UTF-8 bytes, the space mark as one byte of its own, so its nodes stay narrow.

Decoding: the bytes of all pieces lie in one pool; an id is an offset and a length in it.

The model file is a parameter, read by the driver (its size is checked) and shipped.  Models of
another kind (unigram, a normalisation table, user-defined or unused pieces, no byte pieces) are refused.

Defined cases: null text counts as empty and gives no ids; ids and texts may repeat; extra columns,
whatever their names, are ignored; an empty table gives no rows; a text of any length is encoded
whole, with some 10 bytes of tables a character where it has no place to cut.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array

import numpy as np
import pyarrow as pa
from ahocorasick import STORE_INTS, Automaton
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import read_tokenizer
from .common import hold, map_arrow, table

#: Fixed values of the model file: the space mark, kinds of pieces, fields.
MARK = "▁"
MARK_UTF8 = MARK.encode()
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGING_KIND = 2
UNKNOWN_TEXT = " ⁇ "
MOST_CACHED, MOST_PAIRS = 200_000, 400_000
LONGEST_CACHED = 48
#: Longer runs keep their tables in packed arrays.
LONG_RUN = 10_000


def message(data: bytes) -> dict[int, list]:
    """A protobuf message's values by field number: integers, raw fixed-width bytes, or byte strings."""
    out: dict[int, list] = {}
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value: int | bytes = varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            value, at = data[at:at + size], at + size
        out.setdefault(key >> 3, []).append(value)
    return out


def pack(text: str) -> bytes:
    """UTF-8 with the space mark as a byte that UTF-8 never has."""
    return text.encode().replace(MARK_UTF8, b"\xff")


class MergePieces:
    """Encoder and decoder of one model file."""

    def __init__(self, data: bytes):
        model = message(data)
        trainer, rules = (message(model[k][0]) if k in model else {} for k in (2, 3))
        rows = [message(m) for m in model[1]]
        texts = [row[1][0].decode() for row in rows]
        kinds = [row.get(3, [NORMAL])[0] for row in rows]
        plain = (trainer.get(3, [1])[0] == MERGING_KIND and trainer.get(35, [0])[0] and not trainer.get(24, [0])[0]
                 and not rules.get(2, [b""])[0] and not rules.get(4, [1])[0] and rules.get(5, [1])[0]
                 and set(kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE})
        if not plain:
            raise ValueError("not a plain merging model with byte pieces")
        self.prefix = MARK if rules.get(3, [1])[0] else ""
        self.score = {t: struct.unpack("<f", row[2][0])[0] if 2 in row else 0.0
                      for t, row, kind in zip(texts, rows, kinds) if kind == NORMAL}
        spelled = {t: [i] for i, (t, kind) in enumerate(zip(texts, kinds)) if kind == NORMAL}
        self.byte_id = {int(t[3:5], 16): i for i, (t, kind) in enumerate(zip(texts, kinds)) if kind == BYTE}
        letters = sorted(set("".join(self.score)))
        for c in letters:  # a character of some piece that is no piece itself
            if c not in spelled:
                spelled[c] = self._bytes(c)
        # Tokens that merging can reach, with the trace of their merges.
        self.names: list[str] = []
        self.traces: list[tuple[list[float], list[str], list[str]]] = []
        # In the model's order, so that frequent letters come first among a node's children.
        for t in sorted(spelled, key=lambda t: (spelled[t], t)):
            trace = self._trace(t)
            if trace is not None:
                self.names.append(t)
                self.traces.append(trace)
        number = {t: i for i, t in enumerate(self.names)}
        packed = [pack(t) for t in self.names]
        self.size = [len(p) for p in packed]
        self.single = [0] * 256
        self.longest = Automaton(STORE_INTS)
        for i, p in enumerate(packed):
            if len(p) > 1:
                self.longest.add_word(p.decode("latin-1"), i)
            else:
                self.single[p[0]] = i
        if len(self.longest):
            self.longest.make_automaton()
        self.ids = [array("I", spelled[t]).tobytes() for t in self.names]
        self.digits = [",".join(map(str, spelled[t])) for t in self.names]
        self.shorter = [next((number[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in number), -1)
                        for t in self.names]
        known = "".join(map(re.escape, letters))
        words = "".join(re.escape(c) for c in letters if c != MARK)
        by_word = MARK in letters and words and not any(MARK in t.lstrip(MARK) for t in self.names)
        self.cut = re.compile(f"{MARK}*[{words}]+|{MARK}+|[^{known}]" if by_word else f"[{known}]+|[^{known}]")
        self.letters = set(letters)
        self.compatible: dict[tuple[int, int], bool] = {}
        self.kept: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}
        # The offset table: id -> where its bytes start in the pool, and how many they are.
        shown = {UNKNOWN: lambda t: UNKNOWN_TEXT.encode(), CONTROL: lambda t: b"",
                 BYTE: lambda t: bytes([int(t[3:5], 16)]), NORMAL: lambda t: t.replace(MARK, " ").encode()}
        raw = [shown[kind](t) for t, kind in zip(texts, kinds)]
        self.is_byte = np.array([kind == BYTE for kind in kinds])
        self.starts_word = np.array([kind == NORMAL and t.startswith(MARK) for t, kind in zip(texts, kinds)])
        self.length = np.array([len(r) for r in raw], np.int64)
        self.offset = np.cumsum(self.length) - self.length
        self.pool = np.frombuffer(b"".join(raw), np.uint8)

    def _bytes(self, char: str) -> list[int]:
        return [self.byte_id[b] for b in char.encode()]

    def _trace(self, text: str):
        """Merge a piece from its characters: scores, first and last symbols after each merge.

        None if merging does not end with the piece as a whole.
        """
        symbols = list(text)
        scores, first, last = [], [symbols[0]], [symbols[-1]]
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = self.score.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return None
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            scores.append(best)
            first.append(symbols[0])
            last.append(symbols[-1])
        return scores, first, last

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the joined characters of two tokens keeps them apart (kept in a table)."""
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) >= MOST_PAIRS:
                self.compatible.clear()
            known = self.compatible[left, right] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        left_scores, _, ends = self.traces[left]
        right_scores, starts, _ = self.traces[right]
        p = q = 0
        while True:
            a = left_scores[p] if p < len(left_scores) else -np.inf
            b = right_scores[q] if q < len(right_scores) else -np.inf
            across = self.score.get(ends[p] + starts[q])
            # Of equal scores the leftmost merge goes first: left token, border, right token.
            if across is not None and across > a and across >= b:
                return False
            if p == len(left_scores) and q == len(right_scores):
                return True
            if p < len(left_scores) and a >= b:
                p += 1
            else:
                q += 1

    def encode_run(self, text: str) -> list[int]:
        """Token numbers of a text all of whose characters are known."""
        raw = pack(text)
        n = len(raw)
        best = [self.single[b] for b in raw] if n < LONG_RUN else array("i", (self.single[b] for b in raw))
        best.append(0)
        size, shorter, compatible = self.size, self.shorter, self.compatible
        if n > 1 and len(self.longest):
            for end, token in self.longest.iter(raw.decode("latin-1")):
                best[end - size[token] + 1] = token
        out = [] if n < LONG_RUN else array("i")
        failed = bytearray((n >> 3) + 1)
        at, token, left = 0, best[0], -1
        while at < n:
            after = at + size[token]
            if not failed[after >> 3] >> (after & 7) & 1:
                fits = left < 0 or compatible.get((left, token))
                if fits is None:
                    fits = self.fits(left, token)
                if fits:
                    out.append(token)
                    at, token, left = after, best[after], token
                    continue
            token = shorter[token]
            while token < 0:  # nothing fits here: step back
                failed[at >> 3] |= 1 << (at & 7)
                last = out.pop()
                left = out[-1] if out else -1
                at -= size[last]
                token = shorter[last]
        return list(out)

    def _cut_ids(self, cut: str) -> tuple[bytes, str]:
        entry = self.older.pop(cut, None)
        if entry is None:
            if cut[0] in self.letters:
                run = self.encode_run(cut)
                entry = b"".join([self.ids[t] for t in run]), ",".join([self.digits[t] for t in run])
            else:
                ids = self._bytes(cut)
                entry = array("I", ids).tobytes(), ",".join(map(str, ids))
        if len(cut) <= LONGEST_CACHED:
            if len(self.kept) >= MOST_CACHED:  # cuts not met since the last turn go
                self.kept, self.older = {}, self.kept
            self.kept[cut] = entry
        return entry

    def encode(self, text: str) -> tuple[np.ndarray, str]:
        """Ids (uint32), and the same ids as decimals joined by commas."""
        if not text:
            return np.array([], np.uint32), ""
        miss = self._cut_ids
        found = [self.kept.get(c) or miss(c) for c in self.cut.findall(self.prefix + text.replace(" ", MARK))]
        return np.frombuffer(b"".join([f[0] for f in found]), np.uint32), ",".join([f[1] for f in found])

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; the space mark that encoding put in front goes."""
        size = self.length[ids]
        ends = np.cumsum(size)
        index = np.repeat(self.offset[ids] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)
        data = self.pool[index].tobytes()
        shown = ids[size > 0]
        if self.prefix and len(shown) and self.starts_word[shown[0]]:
            data = data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return _spelled_out(data)


def _spelled_out(data: bytes) -> str:
    """Broken UTF-8: each byte that starts no whole character becomes U+FFFD."""
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at:at + size].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            size = 1
            out.append("�")
        at += size
    return "".join(out)


_BUILT: dict[str, MergePieces] = {}


def built(data: bytes) -> MergePieces:
    """One encoder for each worker process and model file."""
    hold("pieces", _BUILT.clear)
    key = hashlib.sha256(data).hexdigest()
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = MergePieces(data)
    return _BUILT[key]


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = False, with_text: bool = False) -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256, decoded_sha256 (and ids, decoded text if asked)."""
    shipped = docs.sparkSession.sparkContext.broadcast(read_tokenizer(model))
    kinds = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    kinds |= {"ids": pa.list_(pa.int64())} if with_ids else {}
    kinds |= {"decoded": pa.string()} if with_text else {}
    schema = ("id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
              + ", ids array<long>" * with_ids + ", decoded string" * with_text)

    def row(pieces: MergePieces, text: str) -> dict:
        ids, digits = pieces.encode(text)
        decoded = pieces.decode(ids)
        return {"n_tokens": len(ids), "ids_sha256": hashlib.sha256(digits.encode()).hexdigest(),
                "decoded_sha256": hashlib.sha256(decoded.encode()).hexdigest(),
                "ids": ids.tolist() if with_ids else None, "decoded": decoded if with_text else None}

    def run(batches):
        pieces = built(shipped.value)
        for batch in batches:
            rows = [row(pieces, cell.as_py() or "") for cell in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([r[c] for r in rows], kind) for c, kind in kinds.items()]],
                ["id", *kinds])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_arrow(rows, run, schema).withColumnRenamed("id", id_col)


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(table(spark, sf_dir, "documents"), default_model())

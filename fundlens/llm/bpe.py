"""BPE encoding and decoding with tree concatenation.

For ``tokenizers`` files whose pre-tokenizer removes white space, so that
pieces between white space encode independently.  A piece's ids are kept in a
bounded cache per Python worker.

Long texts are cut by halving, without regard to words, into leaves of at most
``LEAF_CHARS`` characters, which are encoded in parallel as rows of their own
(also a text without any white space).  A document's leaves are then
concatenated as a tree.  At each join a window around it is encoded again; if
it repeats, token by token and place by place, a run of the left side's tokens
and a run of the right side's, the three are spliced inside those runs,
otherwise the window doubles (in the end it holds both sides whole).  The splice
is exact: BPE accepts a token sequence if and only if it accepts every two
neighbours, and each two neighbours of the result are neighbours in one of the
three encodings.

A null text counts as empty and has no ids; rows repeated whole are encoded
each; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlens.llm.batches import release
from fundlens.llm.frames import small_batches

LEAF_CHARS = 65_536
#: Characters on each side of a join that are first encoded again.
WINDOW = 64
#: Equal tokens that count as agreement.
RUN = 4
#: Pieces kept by a worker before its cache starts anew; of them the first,
#: among which are the frequent ones, up to a length, for its next task; and the
#: longest of those made of others that are kept.
CACHE = 600_000
NEXT, LETTERS = 100_000, 32
COMPOUND = 12

#: The pre-tokenizer's pattern for lower-case ASCII pieces.
ASCII_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t\n\r\x0b\x0ca-z0-9]+")
#: White space to Python's split but not to the tokenizer.
_ODD_SPACE = "\x1c\x1d\x1e\x1f"
_SPACE = re.compile("[ \t\n\r\x0b\x0c]+")


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself
    if printable in Latin-1, else the next code point from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class Encoder(dict):
    """Piece -> its ids as bytes (``dtype``), made on first use."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        with open(path) as file:
            parts = json.load(file)
        specials = [t["content"] for t in parts["added_tokens"]]
        self.marked = re.compile("|".join(re.escape(s[:2]) for s in specials) or r"(?!)").search
        # bound once: each look at ``tokenizer.model`` makes a new object
        self.tokenize = self.tokenizer.model.tokenize
        pre = parts.get("pre_tokenizer") or {}
        patterns = [p["pattern"]["Regex"] for p in pre.get("pretokenizers", []) if p["type"] == "Split"]
        kinds = [n["type"] for n in (parts.get("normalizer") or {}).get("normalizers", [])]
        #: whether pieces may be cut by ASCII_PIECE
        self.plain = kinds == ["NFC", "Replace", "Lowercase"] and patterns == [
            r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"]
        #: whether a piece of letters holds no special token's beginning
        self.bare = self.plain and not any(s[:2].isalpha() for s in specials)
        self.letters = _byte_letters()
        size = self.tokenizer.get_vocab_size()
        self.code = "H" if size <= 1 << 16 else "I"
        self.dtype = np.dtype(self.code)
        self.names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        #: characters of each token of ASCII text
        self.sizes = np.array([len(n.removesuffix("</w>")) for n in self.names], np.int64)
        self.spans: dict = {}

    def __missing__(self, piece: str) -> bytes:
        if not piece:
            return b""
        if self.bare and piece.isalpha() and piece.isascii():
            if piece.islower():
                return self._keep(piece, [t.id for t in self.tokenize(piece)])
            return self._short(piece, self[piece.lower()])
        if not self.plain or self.marked(piece):
            return self._keep(piece, self.tokenizer.encode(piece, add_special_tokens=False).ids)
        # a capital or a mark at the end is settled without an entry of its
        # own, unless it is short and so likely to come again
        if piece[-1] in ",." and len(piece) > 1 and piece[-2].lower().isalnum() and piece[-2] < "ɐ":
            return self._short(piece, self[piece[:-1]] + self[piece[-1]])
        if piece.isascii() and piece.isprintable():
            parts = ASCII_PIECE.findall(piece.lower())
            if parts == [piece]:
                return self._keep(piece, [t.id for t in self.tokenize(piece)])
            return self._short(piece, b"".join([self[p] for p in parts]))
        if piece.isalpha() and max(piece) < "ɐ":  # letters of Latin alphabets, all composed
            low = piece.lower()
            if low != piece:
                return self._short(piece, self[low])
            part = "".join([self.letters[b] for b in piece.encode()])
            return self._keep(piece, [t.id for t in self.tokenize(part)])
        return self._keep(piece, self.tokenizer.encode(piece, add_special_tokens=False).ids)

    def _keep(self, piece: str, ids: list[int]) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        self[piece] = out = array(self.code, ids).tobytes()
        return out

    def _short(self, piece: str, out: bytes) -> bytes:
        if len(piece) <= COMPOUND:
            if len(self) >= CACHE:
                self.clear()
            self[piece] = out
        return out

    def rest(self) -> None:
        """At the end of a task: keep the tokenizer and the first pieces."""
        kept = dict(islice(((p, ids) for p, ids in self.items() if len(p) <= LETTERS), NEXT))
        self.clear()
        self.update(kept)
        self.spans.clear()
        release()

    def encode(self, text: str) -> bytes:
        """The ids of a text, as the library gives them for the whole."""
        parts = _SPACE.split(text) if any(c in text for c in _ODD_SPACE) else text.split()
        return b"".join(map(self.__getitem__, parts))

    def decode(self, ids: np.ndarray) -> str:
        if self.tokenizer.decoder is None:
            return " ".join([self.names[i] for i in ids.tolist()])
        return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)

    def _span(self, piece: str) -> np.ndarray:
        """First and end characters of a piece's tokens, in two rows."""
        found = self.spans.get(piece)
        if found is None:
            if len(self.spans) >= CACHE // 4:
                self.spans.clear()
            offsets = self.tokenizer.encode(piece, add_special_tokens=False).offsets
            found = self.spans[piece] = np.array(offsets, np.int32).reshape(-1, 2).T
        return found

    def tokens(self, text: str, start: int = 0) -> np.ndarray:
        """Ids, first and end character of a text's tokens as three columns;
        ``start`` is the place of its first character."""
        pieces = _PIECE.findall(text)
        coded = list(map(self.__getitem__, pieces))
        ids = np.frombuffer(b"".join(coded), self.dtype).astype(np.int64)
        count = np.array([len(c) for c in coded], np.int64) // self.dtype.itemsize
        first = np.cumsum(count) - count
        # tokens cover an ASCII piece without gaps
        ends = np.cumsum(self.sizes[ids])
        begin = np.append(0, ends)[:-1]
        places = _starts(text)
        shift = np.repeat(places - np.append(begin, 0)[first], count) if pieces else places
        begin, ends = begin + shift, ends + shift
        for i, piece in enumerate(pieces):
            if not (piece.isascii() and self.plain):
                a, z, span = first[i], first[i] + count[i], self._span(piece)
                begin[a:z], ends[a:z] = span[0] + places[i], span[1] + places[i]
        return np.column_stack([ids, begin + start, ends + start])


def _starts(text: str) -> np.ndarray:
    """Places of the first characters of a text's pieces."""
    letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    solid = np.ones(len(letters) + 1, bool)
    solid[0] = False
    solid[1:] = ~((letters == 32) | (letters - 9 < 5))
    return np.flatnonzero(solid[1:] & ~solid[:-1])


_PIECE = re.compile("[^ \t\n\r\x0b\x0c]+")


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file; it outlives a task (functions are
    shipped by value, so it is kept at a module of the library)."""
    kept = sys.modules["tokenizers"].__dict__.setdefault("_kept_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def cuts(length: int, limit: int = LEAF_CHARS) -> list[int]:
    """The leaves' borders: repeated halving, until none is over ``limit``."""
    parts = 1
    while length > parts * limit:
        parts *= 2
    return [length * i // parts for i in range(parts + 1)]


def _agreement(side: np.ndarray, window: np.ndarray, run: int) -> tuple[int, int] | None:
    """Places in both of a run of equal tokens."""
    have = {tuple(t): i for i, t in enumerate(side.tolist())}
    seen = window.tolist()
    for j in range(len(seen) - run + 1):
        i = have.get(tuple(seen[j]))
        if i is not None and np.array_equal(side[i:i + run], window[j:j + run]) and len(side) >= i + run:
            return i + run // 2, j + run // 2
    return None


def join(text: str, left: np.ndarray, right: np.ndarray, lo: int, mid: int, hi: int,
         tokens, window: int = WINDOW) -> np.ndarray:
    """The tokens of ``text[lo:hi]`` from those of its two sides."""
    while True:
        a, b = max(lo, mid - window), min(hi, mid + window)
        if (a, b) == (lo, hi):
            return tokens(text[lo:hi], lo)
        middle = tokens(text[a:b], a)
        first, last = 0, len(middle)
        keep_left, keep_right = left[:0], right[:0]
        agreed = True
        if a > lo:
            from_ = int(np.searchsorted(left[:, 1], a))
            found = _agreement(left[from_:], middle, RUN)
            agreed = found is not None
            if agreed:
                keep_left, first = left[:from_ + found[0]], found[1]
        if agreed and b < hi:
            to = int(np.searchsorted(right[:, 1], b))
            from_right = int(np.searchsorted(middle[:, 1], mid))
            found = _agreement(right[:to], middle[from_right:], RUN)
            agreed = found is not None
            if agreed:
                keep_right, last = right[found[0]:], from_right + found[1]
        if agreed and first <= last:
            return np.concatenate([keep_left, middle[first:last], keep_right])
        window *= 2


def concatenate(text: str, leaves: list[np.ndarray], borders: list[int], tokens) -> np.ndarray:
    """The tokens of a text from its leaves', joined two by two."""
    while len(leaves) > 1:
        leaves = [join(text, leaves[i], leaves[i + 1], borders[i], borders[i + 1], borders[i + 2], tokens)
                  for i in range(0, len(leaves), 2)]
        borders = borders[::2]
    return leaves[0]


def _packed(tokens: np.ndarray, start: int) -> bytes:
    """A leaf's tokens: each step from one to the next is small."""
    steps = np.diff(tokens[:, 1] - start, prepend=0)
    sizes = tokens[:, 2] - tokens[:, 1]
    kind = "<u2" if max(steps.max(initial=0), sizes.max(initial=0), tokens[:, 0].max(initial=0)) < 1 << 16 else "<u4"
    return kind[-1].encode() + np.concatenate([tokens[:, 0], steps, sizes]).astype(kind).tobytes()


def _unpacked(packed: bytes, start: int) -> np.ndarray:
    ids, steps, sizes = np.frombuffer(packed[1:], "<u" + packed[:1].decode()).astype(np.int64).reshape(3, -1)
    begin = np.cumsum(steps) + start
    return np.column_stack([ids, begin, begin + sizes])


def _lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)])
    flat = np.concatenate(ids) if ids else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32)))


def id_bytes(path: str) -> int:
    """Bytes of an id in packed form: 2 or 4."""
    return 2 if tokenizers.Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4


def encode(df: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None,
           leaf_chars: int = LEAF_CHARS, packed: bool = False, tail: list[int] | None = None,
           hold: bool = False) -> DataFrame:
    """Columns ``keep`` of ``df`` with the texts' ``ids`` and, after each,
    the ids ``tail``: an array, or ``packed`` into little-endian bytes.  With
    ``hold`` a worker keeps its pieces (at most ``CACHE``) for its next task,
    which saves time; otherwise only the first (``NEXT``)."""
    small_batches(df.sparkSession)
    keep = [] if keep is None else keep
    text = F.coalesce(df[text_col], F.lit(""))
    rows = df.select(*[df[f"`{c}`"].alias(f"_{i}") for i, c in enumerate(keep)], text.alias("text"))
    kept = rows.schema.fields[:-1]
    ids = T.StructField("ids", T.BinaryType() if packed else T.ArrayType(T.IntegerType()))
    tail = tail or []

    def column(coded: list[bytes], coder: Encoder) -> pa.Array:
        end = np.array(tail, coder.dtype).tobytes()
        if packed:
            return pa.array([c + end for c in coded], pa.binary())
        return _lists([np.frombuffer(c + end, coder.dtype) for c in coded])

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            got = [coder.encode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column(got, coder)],
                                             [*batch.schema.names[:-1], "ids"])
        if not hold:
            coder.rest()

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            parts = [coder.tokens(t, s) for t, s in zip(
                batch.column("text").to_pylist(), batch.column("start").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([_packed(p, s) for p, s in zip(
                    parts, batch.column("start").to_pylist(), strict=True)], pa.binary())],
                [*batch.schema.names, "tokens"])
        coder.rest()

    def document(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("start")
        texts = parts.column("text").to_pylist()
        borders = [*parts.column("start").to_pylist(), sum(map(len, texts))]
        leaves = [_unpacked(t, s) for t, s in zip(parts.column("tokens").to_pylist(), borders, strict=False)]
        coder = encoder(path)
        whole = concatenate("".join(texts), leaves, borders, coder.tokens)
        first = parts.slice(0, 1).select([f.name for f in kept])
        return first.append_column("ids", column([whole[:, 0].astype(coder.dtype).tobytes()], coder))

    length = F.length("text")
    out = rows.where(length <= leaf_chars).mapInArrow(short, T.StructType([*kept, ids]))
    # a long text's leaves: 2**k of them, cut as by ``cuts``
    n = F.pow(F.lit(2.0), F.ceil(F.log2(length / leaf_chars))).cast("long")
    border = lambda i: F.floor(length.cast("long") * i / n)
    long = rows.where(length > leaf_chars).withColumn("row", F.monotonically_increasing_id())
    long = long.select("*", F.explode_outer(F.sequence(F.lit(0).cast("long"), n - 1)).alias("leaf"))
    start, end = border(F.col("leaf")), border(F.col("leaf") + 1)
    long = long.select(*[f.name for f in kept], "row", start.alias("start"),
                       F.substring(F.col("text"), start.cast("int") + 1, (end - start).cast("int")).alias("text"))
    coded = long.repartition("row", "start").mapInArrow(
        leaf, T.StructType([*long.schema.fields, T.StructField("tokens", T.BinaryType())]))
    whole = coded.groupBy("row").applyInArrow(document, T.StructType([*kept, ids]))
    return out.unionByName(whole).toDF(*keep, "ids")


def decode(df: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the library's text of its ids."""
    schema = T.StructType([*df.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            column = batch.column(ids_col)
            ends, flat = column.offsets.to_numpy(), column.values.to_numpy()
            texts = [coder.decode(flat[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             [*batch.schema.names, "decoded"])
    return df.mapInArrow(run, schema)

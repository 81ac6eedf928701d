"""Alignment of two tokenizers' ids over the same bytes, with corpus-wide counts of linked ids.

Tokenizer A is a byte-level BPE (``tokenizers``), applied to a blank and the text;
tokenizer B a SentencePiece model that adds this blank itself. Both encode the whole
text; special strings inside it are plain text. The bytes of each side's tokens must
give the blank and the text, else the document counts as one without tokens.

1. Anchors: byte offsets where tokens of both sides end and the next token of both
   begins with a blank. They cut a document into windows, pairs of id tuples. Where both
   tokenizers encode the stretches between single blanks apart from each other, a text's
   ids are those of its stretches, kept by stretch with their window.
2. Windows are numbered by their two id tuples in a cache of each worker, bounded in entries.
   A window's alignment (groups between shared ends, links between tokens that overlap) is
   found once for all its occurrences: once a task to count linked pairs, and once a block
   of documents to score them. Which windows are cached changes the speed, never the result.
3. ``align`` writes blocks of documents (their windows, each once, and each document's
   window numbers) and each task's sums of linked id pairs to one table in the shared
   folder. Its pairs are added up by pair.
4. ``linked`` reads the blocks and looks each pair's count up: the ``HELD_PAIRS`` most
   frequent pairs are broadcast (at most 17 bytes each); links of the others, rare by
   choice, leave as (pair, times) and get their counts by a join.

Defined cases: a NULL or empty text has no tokens, no groups and no links; repeated rows
each count and each give a row; an empty table gives no rows; other columns are
ignored, whatever their names. A pair ties for a B id's highest count if its count
equals it.
"""

from __future__ import annotations

import gc
import os
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import count, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendstar.llm import bpe
from spendstar.llm.common import prepare
from spendstar.session import scratch_path

HELD_PAIRS = 1 << 20
# Pieces and windows in a worker's cache.
CACHE_LIMIT = 400_000
# Bytes of texts in a block of documents, and of the table's row groups.
BLOCK_BYTES = 1 << 19
GROUP_BYTES = 1 << 24
PAIRS_PER_ROW = 50_000
# Pieces encoded with one text.
TOGETHER = 64
ESCAPE = "▁"

_STOPS = frozenset(".,;:!?")
_SHIFT = 32  # a link's key: A's id above B's


def _byte_of_char() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, others follow U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(shifted)}


class Side:
    """One tokenizer: ids of whole texts, each after a blank, and bytes of ids."""

    def __init__(self, data: list[bytes], ids: np.dtype):
        self.data, self.ids = data, ids
        self.sizes = np.array([len(d) for d in data])
        self.blank = np.array([d.startswith(b" ") for d in data])
        self.line_break = np.array([d == b"\n" for d in data])
        self.tails: dict[str, bytes] = {}

    def of_text(self, text: str) -> list[int]:
        """Ids of a whole text after a blank, by the library."""
        raise NotImplementedError

    def of_tail(self, char: str) -> list[int]:
        """Ids of one character without a blank."""
        raise NotImplementedError

    def cut(self, piece: str) -> bool:
        """Whether the last character's ids are its own, whatever is before it in the piece."""
        raise NotImplementedError

    def apart(self, text: str) -> bool:
        """Whether the text's ids are those of its pieces."""
        raise NotImplementedError

    def written(self, ids: list[int]) -> bytes:
        return np.array(ids, self.ids).tobytes()

    def tail(self, char: str) -> bytes:
        if char not in self.tails:
            self.tails[char] = self.written(self.of_tail(char))
        return self.tails[char]

    def bytes_of(self, ids: bytes) -> bytes:
        return b"".join(map(self.data.__getitem__, np.frombuffer(ids, self.ids).tolist()))

    def of_texts(self, texts: list[str]) -> list[list[int]]:
        return list(map(self.of_text, texts))

    def of_pieces(self, pieces: list[str], lead: str, between: str, starts: np.ndarray) -> Iterator[bytes | None]:
        """Ids of each piece, from those of texts that hold many of them.

        ``starts`` marks the tokens that begin a piece; ``lead`` is one token before the first
        piece (or none). Where a text's tokens are not as expected its pieces are encoded alone.
        """
        some = [pieces[k : k + TOGETHER] for k in range(0, len(pieces), TOGETHER)]
        texts = [lead + between.join(part) for part in some]
        for part, text, ids in zip(some, texts, self.of_texts(texts), strict=True):
            ids = self.written(ids)
            at = np.flatnonzero(starts[np.frombuffer(ids, self.ids)])
            if len(at) != len(part) or at[0] != len(lead) or self.bytes_of(ids) != (" " + text).encode("utf-8", "replace"):
                # a piece after a line break has no ids of its own then
                yield from [None if lead else self.alone(p) for p in part]
            else:
                bounds = [*(at * self.ids.itemsize).tolist(), len(ids)]
                yield from [ids[i:j] for i, j in pairwise(bounds)]

    def alone(self, piece: str) -> bytes | None:
        """Ids of a piece after a blank; None if their bytes are others."""
        ids = self.written(self.of_text(piece))
        return ids if self.bytes_of(ids) == (" " + piece).encode("utf-8", "replace") else None


class ByteLevel(Side):
    """The byte-level BPE. Its pre-tokeniser cuts before each single blank, and between a letter and a stop."""

    def __init__(self, path: str, ids: np.dtype | None = None):
        self.tokenizer = bpe.load(path)
        self.tokenizer.encode_special_tokens = True
        alphabet = _byte_of_char()
        added = self.tokenizer.get_added_tokens_decoder()
        data = [b""] * self.tokenizer.get_vocab_size()
        for token, i in self.tokenizer.get_vocab().items():
            data[i] = token.encode() if i in added else bytes(alphabet[c] for c in token)
        super().__init__(data, ids or _width(len(data)))

    def of_text(self, text: str) -> list[int]:
        return self.tokenizer.encode(" " + text, add_special_tokens=False).ids

    def of_texts(self, texts: list[str]) -> list[list[int]]:
        batch = self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in batch]

    def of_tail(self, char: str) -> list[int]:
        return self.tokenizer.encode(char, add_special_tokens=False).ids

    def cut(self, piece: str) -> bool:
        # a letter of the Latin blocks, which are letters in any Unicode version
        return piece[-2] < "\u0250" and piece[-2].isalpha()

    def apart(self, text: str) -> bool:
        return "  " not in text and text[0] != " " and text[-1] != " "


class Pieces(Side):
    """The SentencePiece model, which itself sets a blank before a text."""

    def __init__(self, path: str, ids: np.dtype | None = None):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        with open(path, "rb") as f:
            proto = pb.ModelProto.FromString(f.read())
        kinds = pb.ModelProto.SentencePiece
        super().__init__(
            [
                bytes([int(p.piece[3:5], 16)])
                if p.type == kinds.BYTE
                else p.piece.replace(ESCAPE, " ").encode()
                if p.type in (kinds.NORMAL, kinds.USER_DEFINED)
                else b""
                for p in proto.pieces
            ],
            ids or _width(len(proto.pieces)),
        )
        texts = [p.piece for p in proto.pieces if p.type in (kinds.NORMAL, kinds.USER_DEFINED)]
        norm = proto.normalizer_spec
        # pieces can be encoded on their own if no token goes on past the start of an escaped blank
        self.cuts = (
            proto.trainer_spec.model_type == pb.TrainerSpec.BPE
            and not any(ESCAPE in t.lstrip(ESCAPE) for t in texts)
            and not any(p.type == kinds.USER_DEFINED for p in proto.pieces)
            and norm.add_dummy_prefix
            and not (norm.precompiled_charsmap or norm.remove_extra_whitespaces)
            and norm.escape_whitespaces
        )
        self.cuts = self.cuts and not any("\n" in t for t in texts)
        self.joints = {t[k : k + 2] for t in texts for k in range(len(t) - 1)}
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        norm.add_dummy_prefix = False
        self.bare = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())

    def of_text(self, text: str) -> list[int]:
        return self.whole.encode(text)

    def of_tail(self, char: str) -> list[int]:
        return self.bare.encode(char)

    def cut(self, piece: str) -> bool:
        return self.cuts and piece[-2:] not in self.joints

    def apart(self, text: str) -> bool:
        return self.cuts and "  " not in text and text[0] != " " and text[-1] != " " and ESCAPE not in text


def _width(size: int) -> np.dtype:
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


class _Sure(dict):
    """Whether both sides have a sure boundary between two characters, a stop the second."""

    def __init__(self, tool: Aligner):
        super().__init__()
        self.tool = tool

    def __missing__(self, pair: str) -> bool:
        out = self[pair] = len(pair) == 2 and all(side.cut(pair) for side in self.tool.sides)
        return out


class Aligner:
    """Encodes texts by two tokenizers and aligns windows of their ids."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.sides = (self.a, self.b)
        # ids as text with what follows them inside and at the end of a group's side
        self.code_text: list[bytes] = []
        self.first_code: list[int] = []
        for side, end in zip(self.sides, (b"|", b";"), strict=True):
            self.first_code.append(len(self.code_text))
            for i in range(len(side.data)):
                self.code_text += [b"%d," % i, b"%d%s" % (i, end)]
        self.empty()

    def empty(self) -> None:
        # each side's ids of parts of pieces; None where their bytes are not the part's
        self.known: tuple[dict[str, bytes | None], ...] = ({}, {})
        # windows by their id tuples, and the window of each piece (-1: it has none)
        self.window: dict[tuple[bytes, bytes], int] = defaultdict(count().__next__)
        self.piece: dict[str, int] = {}
        self.sure = _Sure(self)

    def full(self) -> bool:
        return len(self.piece) > CACHE_LIMIT or len(self.window) > CACHE_LIMIT or len(self.known[0]) > CACHE_LIMIT

    def learn(self, pieces: set[str]) -> None:
        """Find the windows of new pieces (stretches after a blank, without one), many encoded with one call.

        Lone line breaks, and stops after a letter, are sure boundaries of both sides:
        the parts between them repeat more often than the pieces.
        """
        known, b = self.known[0], self.b
        words: dict[str, None] = {}  # after a blank
        lines: dict[str, None] = {}  # after a line break, which they begin with
        alone: list[str] = []
        cut: list[str] = []
        broken: list[tuple[str, list[str]]] = []
        new = list(pieces.difference(self.piece))

        def need(part: str) -> None:
            if part not in known:
                if part[-1:] in _STOPS and self.sure[part[-2:]]:
                    cut.append(part)
                    part = part[:-1]
                    if part in known:
                        return
                (lines if part[0] == "\n" else words)[part] = None

        for piece in new:
            if piece.isprintable():
                need(piece)
                continue
            parts = piece.split("\n")
            if not b.cuts or not all(p and p.isprintable() for p in parts):
                alone.append(piece)
                continue
            parts[1:] = ["\n" + p for p in parts[1:]]
            broken.append((piece, parts))
            for part in parts:
                need(part)
        for side, of_side in zip(self.sides, self.known, strict=True):
            of_side.update(zip(words, side.of_pieces(list(words), "", " ", side.blank), strict=True))
            of_side.update(zip(lines, side.of_pieces(list(lines), "x", "", side.line_break), strict=True))
            for piece in alone:
                of_side[piece] = side.alone(piece)
            for part in cut:
                ids = of_side[part[:-1]]
                of_side[part] = ids and ids + side.tail(part[-1])
            for piece, parts in broken:
                ids = list(map(of_side.__getitem__, parts))
                of_side[piece] = None if None in ids else b"".join(ids)
        both = zip(*[map(of_side.__getitem__, new) for of_side in self.known], strict=True)
        self.piece.update(zip(new, [-1 if None in ids else self.window[ids] for ids in both], strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The windows of each text; none if the bytes of its ids are not those of a blank and the text."""
        split = [t.split(" ") if t and all(s.apart(t) for s in self.sides) else [] for t in texts]
        self.learn(set().union(*split))
        out = []
        for text, pieces in zip(texts, split, strict=True):
            found = np.fromiter(map(self.piece.__getitem__, pieces), np.int64, len(pieces))
            if text and (not pieces or found.min() < 0):
                ids = [s.alone(text) for s in self.sides]
                windows = [] if None in ids else self.cut(*ids)
                found = np.fromiter(map(self.window.__getitem__, windows), np.int64, len(windows))
            out.append(found)
        return out

    def cut(self, ids_a: bytes, ids_b: bytes) -> list[tuple[bytes, bytes]]:
        """The windows between the anchors of a whole text's ids on both sides."""
        first, start = [], []
        for side, ids in zip(self.sides, (ids_a, ids_b), strict=True):
            tokens = np.frombuffer(ids, side.ids)
            size = side.sizes[tokens]
            blank = np.flatnonzero(side.blank[tokens])
            first.append(blank)
            start.append((size.cumsum() - size)[blank])
        at = np.searchsorted(start[1], start[0])
        at[at == len(start[1])] = 0
        shared = start[1][at] == start[0]
        cut_a = (first[0][shared] * self.a.ids.itemsize).tolist()
        cut_b = (first[1][at[shared]] * self.b.ids.itemsize).tolist()
        return [
            (ids_a[i:j], ids_b[k:m])
            for i, j, k, m in zip(cut_a, [*cut_a[1:], len(ids_a)], cut_b, [*cut_b[1:], len(ids_b)], strict=True)
        ]

    def joined(self, windows: list[tuple[bytes, bytes]]) -> list[bytes]:
        """Ids of all windows and tokens of each, for both sides."""
        out = []
        for k, side in enumerate(self.sides):
            part = [w[k] for w in windows]
            out += [b"".join(part), np.array([len(p) // side.ids.itemsize for p in part], "<u4").tobytes()]
        return out

    def align(self, ids_a: bytes, tokens_a: bytes, ids_b: bytes, tokens_b: bytes, with_text: bool = False):
        """Of joined windows: keys of all links, links and groups per window, each window's groups as text."""
        ids = [np.frombuffer(x, side.ids).astype(np.int64) for x, side in zip((ids_a, ids_b), self.sides, strict=True)]
        until = [np.frombuffer(x, "<u4").cumsum() for x in (tokens_a, tokens_b)]
        ends_a, ends_b = [side.sizes[x].cumsum() for side, x in zip(self.sides, ids, strict=True)]
        # a link ends wherever a token of either side does, a group where tokens of both do
        mark = np.zeros(ends_a[-1] + 1, np.uint8)
        mark[ends_a] = 1
        mark[ends_b] += 2
        of_end = mark[np.flatnonzero(mark)]
        in_a, in_b, shared = of_end & 1, of_end >> 1, of_end == 3
        at_a, at_b = in_a.cumsum(dtype=np.int64) - in_a, in_b.cumsum(dtype=np.int64) - in_b
        keys = ids[0][at_a] << _SHIFT | ids[1][at_b]
        closing = (mark > 0).cumsum()[ends_a[until[0] - 1]]
        links = np.diff(closing, prepend=0)
        groups = np.diff(shared.cumsum()[closing - 1], prepend=0)
        if not with_text:
            return keys, links, groups, []
        # each group is its tokens of A, then those of B
        last_a, last_b = at_a[shared], at_b[shared]
        codes = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        passed = np.concatenate(([0], last_b + 1)), last_a + 1
        for x, last, other, first in zip(ids, (last_a, last_b), passed, self.first_code, strict=True):
            closes = np.zeros(len(x), np.int64)
            closes[last] = 1
            group = closes.cumsum() - closes
            codes[np.arange(len(x)) + other[group]] = first + 2 * x + closes
        parts = list(map(self.code_text.__getitem__, codes.tolist()))
        bounds = [0, *(until[0] + until[1]).tolist()]
        return keys, links, groups, [b"".join(parts[i:j])[:-1] for i, j in pairwise(bounds)]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


@contextmanager
def _without_collector():
    """Millions of cached tuples hold no cycles; looking for some takes a sixth of a task's time."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def aligner(path_a: str, path_b: str) -> Aligner:
    # a task has one core
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


class _PairSums:
    """Sums of linked pairs of one task, counted by window; given out whenever the cache is full."""

    def __init__(self, tool: Aligner):
        self.tool, self.times = tool, np.zeros(0, np.int64)

    def add(self, numbers: np.ndarray) -> None:
        times = np.bincount(numbers, minlength=len(self.times))
        times[: len(self.times)] += self.times
        self.times = times

    def give(self) -> tuple[np.ndarray, np.ndarray]:
        """(keys, sums) so far; starts anew."""
        seen = np.flatnonzero(self.times)
        if not len(seen):
            return seen, seen
        windows = list(self.tool.window)
        keys, links, _, _ = self.tool.align(*self.tool.joined([windows[k] for k in seen.tolist()]))
        times = np.repeat(self.times[seen], links)
        self.times = np.zeros(0, np.int64)
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
        firsts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[firsts], np.add.reduceat(times, firsts)


def _blocks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``BLOCK_BYTES``."""
    size, lo = 0, 0
    for k, n in enumerate(sizes):
        size += n
        if size > BLOCK_BYTES or k == len(sizes) - 1:
            yield lo, k + 1
            size, lo = 0, k + 1


# A row is a block of documents, or a part of a task's sums. ``numbers`` (four bytes each) are
# the documents' windows, ``windows`` how many each has; ids and their number per window by side.
_BLOCKS = pa.schema(
    [
        ("row", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("windows", pa.list_(pa.int32())),
        *[(name, pa.binary()) for name in ("numbers", "ids_a", "tokens_a", "ids_b", "tokens_b")],
        ("pairs", pa.list_(pa.struct([("key", pa.int64()), ("n", pa.int64())]))),
    ]
)
_BLOCKS_SQL = (
    "row long, doc_ids array<long>, windows array<int>, numbers binary, ids_a binary, tokens_a binary, "
    "ids_b binary, tokens_b binary, pairs array<struct<key: long, n: long>>"
)


def _row(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([values], schema=_BLOCKS)


def _pair_rows(keys: np.ndarray, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(keys), PAIRS_PER_ROW):
        part = pa.StructArray.from_arrays(
            [pa.array(keys[lo : lo + PAIRS_PER_ROW]), pa.array(sums[lo : lo + PAIRS_PER_ROW])], names=["key", "n"]
        )
        pairs = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part)
        nothing = [pa.nulls(1, f.type) for f in list(_BLOCKS)[:-1]]
        yield pa.RecordBatch.from_arrays([*nothing, pairs.cast(_BLOCKS.field("pairs").type)], schema=_BLOCKS)


@dataclass
class Aligned:
    """Written blocks of all documents and counts of all linked pairs."""

    path_a: str
    path_b: str
    blocks: DataFrame
    totals: DataFrame  # key, n, best (n is the highest of the key's B id)


def align(docs: DataFrame, path_a: str, path_b: str) -> Aligned:
    """Encode every row of ``docs`` (doc_id, text) by both tokenizers and count the linked id pairs."""
    spark: SparkSession = docs.sparkSession
    prepare(spark)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _without_collector():
            yield from encode_blocks(batches)

    def encode_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(path_a, path_b)
        sums = _PairSums(tool)
        row = TaskContext.get().partitionId() << _SHIFT
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in _blocks([len(t) for t in texts]):
                if tool.full():
                    yield from _pair_rows(*sums.give())
                    tool.empty()
                found = tool.encode(texts[lo:hi])
                numbers = np.concatenate(found)
                sums.add(numbers)
                own, numbers = np.unique(numbers, return_inverse=True)
                windows = list(tool.window)
                ids_a, tokens_a, ids_b, tokens_b = tool.joined([windows[k] for k in own.tolist()])
                yield _row(
                    row=row,
                    doc_ids=batch.column(0).slice(lo, hi - lo).to_pylist(),
                    windows=[len(f) for f in found],
                    numbers=numbers.astype("<u4").tobytes(),
                    ids_a=ids_a,
                    tokens_a=tokens_a,
                    ids_b=ids_b,
                    tokens_b=tokens_b,
                )
                row += hi - lo
        yield from _pair_rows(*sums.give())

    texts = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text")
    )
    path = scratch_path(spark, "alignment")
    writer = texts.mapInArrow(encode, _BLOCKS_SQL).write.mode("overwrite").option("compression", "zstd")
    # a reader holds a row group's rows at once
    writer.option("parquet.block.size", GROUP_BYTES).parquet(path)
    written = spark.read.schema(_BLOCKS_SQL).parquet(path)
    counts = (
        written.where(F.col("pairs").isNotNull())
        .select(F.inline("pairs"))
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
        .checkpoint()
    )
    of_b = F.col("key").bitwiseAND((1 << _SHIFT) - 1)
    # at most one row for each id of B
    highest = counts.groupBy(of_b.alias("b")).agg(F.max("n").alias("most"))
    totals = counts.join(F.broadcast(highest), of_b == F.col("b")).select(
        "key", "n", (F.col("n") == F.col("most")).alias("best")
    )
    return Aligned(path_a, path_b, written.where(F.col("row").isNotNull()).drop("pairs"), totals)


def _block_scores(tool: Aligner, block: dict, held: tuple[np.ndarray, np.ndarray, np.ndarray]):
    """(numbers per document: groups, links, best links, count sum; its groups; its rare links)."""
    keys, counts, best = held
    sizes = block["windows"]
    sums, rare = np.zeros((len(sizes), 4), np.int64), [[] for _ in sizes]
    if not block["numbers"]:
        return sums, [b""] * len(sizes), rare
    links, per_window, groups, texts = tool.align(
        block["ids_a"], block["tokens_a"], block["ids_b"], block["tokens_b"], with_text=True
    )
    at = np.searchsorted(keys, links)
    at[at == len(keys)] = 0
    known = keys[at] == links if len(keys) else np.zeros(len(links), bool)
    own = np.zeros((len(links), 2), np.int64)
    own[known, 0] = best[at[known]]
    own[known, 1] = counts[at[known]]
    firsts = per_window.cumsum() - per_window
    of_window = np.column_stack([groups, per_window, np.add.reduceat(own, firsts)])
    numbers = np.frombuffer(block["numbers"], "<u4")
    bounds = [0, *np.cumsum(sizes).tolist()]
    # a document without windows takes no part, or the next one's first would count for it
    some = np.flatnonzero(sizes)
    sums[some] = np.add.reduceat(of_window[numbers], np.array(bounds[:-1])[some])
    parts = list(map(texts.__getitem__, numbers.tolist()))
    if not known.all():
        missed: dict[int, list[int]] = {}
        owner = np.repeat(np.arange(len(per_window)), per_window)
        for w, link in zip(owner[~known].tolist(), links[~known].tolist(), strict=True):
            missed.setdefault(w, []).append(link)
        for k, (i, j) in enumerate(pairwise(bounds)):
            times: dict[int, int] = {}
            for w in numbers[i:j].tolist():
                for link in missed.get(w, ()):
                    times[link] = times.get(link, 0) + 1
            rare[k] = [{"key": key, "times": n} for key, n in times.items()]
    return sums, [b";".join(parts[i:j]) for i, j in pairwise(bounds)], rare


def _tokens(block: dict, side: str) -> np.ndarray:
    """Tokens of each document on one side."""
    of_window = np.frombuffer(block["tokens_" + side], "<u4")[np.frombuffer(block["numbers"], "<u4")]
    until = np.concatenate(([0], of_window.cumsum(dtype=np.int64)))
    ends = np.cumsum(block["windows"])
    return np.diff(until[ends], prepend=0)


_LINKED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups string, rare array<struct<key: long, times: long>>"
)


def linked(aligned: Aligned, held_pairs: int = HELD_PAIRS) -> DataFrame:
    """Per document its numbers, its groups as text, and its links to pairs that are not held.

    ``n_best`` and ``count_sum`` are without those links until ``with_rare_links`` adds them.
    """
    spark = aligned.blocks.sparkSession
    top = aligned.totals.orderBy(F.desc("n"), "key").limit(held_pairs).toArrow()
    keys = top.column("key").to_numpy()
    order = np.argsort(keys)
    held = (keys[order], top.column("n").to_numpy()[order], top.column("best").to_numpy(zero_copy_only=False)[order])
    sent = spark.sparkContext.broadcast(held)
    path_a, path_b = aligned.path_a, aligned.path_b

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _without_collector():
            yield from score_blocks(batches)

    def score_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(path_a, path_b)
        names = [f.split()[0] for f in _LINKED.split(", ")[:9]] + ["rare"]
        for batch in batches:
            for k in range(batch.num_rows):
                block = batch.slice(k, 1).to_pylist()[0]
                sums, texts, rare = _block_scores(tool, block, sent.value)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(block["row"], block["row"] + len(texts))),
                        pa.array(block["doc_ids"], pa.int64()),
                        pa.array(_tokens(block, "a")),
                        pa.array(_tokens(block, "b")),
                        *[pa.array(np.ascontiguousarray(sums[:, c])) for c in range(4)],
                        pa.array(texts, pa.binary()).cast(pa.string()),
                        pa.array(rare, pa.list_(pa.struct([("key", pa.int64()), ("times", pa.int64())]))),
                    ],
                    names=names,
                )

    return aligned.blocks.mapInArrow(score, _LINKED)


def with_rare_links(found: DataFrame, aligned: Aligned) -> DataFrame:
    """``found`` (columns of ``linked``, any of them changed or left out but row, the sums and ``rare``) with all links.

    ``found`` is written once; only its links to pairs that are not held are shuffled, and a
    number per document that has some.
    """
    found = found.checkpoint()
    rare = (
        found.select("row", F.inline("rare"))
        .join(aligned.totals, "key")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"),
            F.sum(F.col("times") * F.col("n")).alias("more_sum"),
        )
    )
    return (
        found.drop("rare")
        .join(rare, "row", "left")
        .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
        .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0)))
        .drop("more_best", "more_sum")
    )

"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search runs over the characters of a normalised text and keeps, for each
boundary of the last ``longest piece`` characters, its best path and a back
pointer. Whenever all these paths run through one boundary, the ids before it are
committed and forgotten, so memory follows the longest piece and the stretch over which
paths do not converge, not the text.

For unigram models the best path has the largest sum of scores. For BPE models a
sum of scores would give other ids than the merges do, so a path is *valid* instead
of best: each prefix of a text has one encoding, a boundary's path is that
encoding, and a piece may follow another exactly if merging the two pieces'
characters gives back those two. (This holds because a merge's rank depends on the
merged piece alone; tests compare with the library.) Characters without a piece
are written as their UTF-8 bytes.

White space is escaped and, where no piece continues past the start of an escaped
blank, such a start is a boundary that all paths share; so is every place between two
characters that no piece holds in this order. The text is cut there, and the ids of
the stretches, which repeat, come from a bounded cache in each worker. A short stretch of a
BPE model is searched at once: depth first, the longest piece first, for the same valid path.

Defined cases: a NULL or empty text has no ids and is decoded to the empty text;
repeated rows each give a row; an empty table gives no rows; other columns are
ignored, whatever their names. The escape character itself is decoded to a blank.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import pairwise
from operator import add
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendstar.llm.common import prepare

ESCAPE = "▁"
CACHE_LIMIT = 400_000
PAIR_LIMIT = 1_000_000
MAX_CACHED_CHARS = 48
# Score below the worst piece's for a character without a piece (unigram models; fixed value).
UNKNOWN_PENALTY = 10.0

_NORMAL, _UNKNOWN, _USER_DEFINED, _BYTE, _BPE = 1, 2, 4, 6, 2


class PieceModel:
    """Pieces, scores and settings of a model file with an identity normaliser."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        with open(path, "rb") as f:
            proto = pb.ModelProto.FromString(f.read())
        if any(p.type == _USER_DEFINED for p in proto.pieces):
            raise ValueError("models with user-defined pieces are not supported")
        norm = proto.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models with an identity normaliser are supported")
        if proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models with white space as suffix are not supported")
        self.bpe = proto.trainer_spec.model_type == _BPE
        self.prefix = norm.add_dummy_prefix
        self.text_of = [p.piece for p in proto.pieces]
        self.id_of = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == _NORMAL}
        self.score_of = [p.score for p in proto.pieces]
        self.byte_of = {i: int(p.piece[3:5], 16) for i, p in enumerate(proto.pieces) if p.type == _BYTE}
        self.id_of_byte = {b: i for i, b in self.byte_of.items()}
        self.silent = {i for i, p in enumerate(proto.pieces) if p.type not in (_NORMAL, _BYTE)}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == _UNKNOWN)
        self.longest = max(map(len, self.id_of))
        # no piece goes on past the start of an escaped blank
        self.cuts = not any(ESCAPE in p.lstrip(ESCAPE) for p in self.id_of)
        self.unknown_score = min(self.score_of[i] for i in self.id_of.values()) - UNKNOWN_PENALTY
        # BPE: pieces that their own characters' merges give; every start of one of them (-1: not
        # such a piece itself) and the length of the longest that ends with a character
        self.usable = {t: i for t, i in self.id_of.items() if self.bpe and self.merged(t) == [t]}
        self.starts = {t[:k]: -1 for t in self.usable for k in range(1, len(t))} | self.usable
        self.length = [len(t) for t in self.text_of]
        self.reach: dict[str, int] = {}
        for t in self.usable:
            self.reach[t[-1]] = max(self.reach.get(t[-1], 0), len(t))
        self.joints = {t[k : k + 2] for t in self.id_of for k in range(len(t) - 1)}
        self.pairs = _Pairs(self)
        self.stretch = re.compile(self._stretches())

    def _stretches(self) -> str:
        """A pattern of stretches, between which no piece lies: they begin at escaped blanks and
        where the largest group of characters that pieces join begins or ends."""
        group = {c: {c} for joint in self.joints for c in joint if c != ESCAPE}
        for a, b in self.joints:
            if ESCAPE not in (a, b) and group[a] is not group[b]:
                less, more = sorted((group[a], group[b]), key=len)
                more |= less
                group.update(dict.fromkeys(less, more))
        most = max(group.values(), key=len, default=set())
        if len(most) < 2:
            return f"{ESCAPE}*[^{ESCAPE}]+|{ESCAPE}+$"
        chars = "".join(map(re.escape, sorted(most)))
        return f"{ESCAPE}*[{chars}]+|{ESCAPE}*[^{ESCAPE}{chars}]+|{ESCAPE}+$"

    def merged(self, text: str) -> list[str]:
        """Merges of a short text's characters, best score first, leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.id_of.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.score_of[i] > best):
                    best, at = self.score_of[i], k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def in_bytes(self, char: str) -> list[int]:
        data = char.encode("utf-8", "replace")
        if all(b in self.id_of_byte for b in data):
            return [self.id_of_byte[b] for b in data]
        return [self.unknown]


class _Pairs(dict):
    """Whether a piece may follow another, by ``before * number of pieces + piece``."""

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model = model

    def __missing__(self, pair: int) -> bool:
        if len(self) >= PAIR_LIMIT:
            self.clear()
        a, b = map(self.model.text_of.__getitem__, divmod(pair, len(self.model.text_of)))
        out = self[pair] = self.model.merged(a + b) == [a, b]
        return out


class Stream:
    """The search over one stretch of normalised text, fed part by part."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.ids: list[int] = []  # committed
        # per boundary since the last commit: start of its last piece, the piece (-1: a
        # character without one) and the path's score; None where no path ends
        self.back: list[tuple[int, int, float] | None] = [(0, -1, 0.0)]
        self.text = ""  # characters since the last commit

    def feed(self, chars: str) -> None:
        # while fewer characters are held, a piece may still begin at the first boundary
        window = self.model.longest
        extend = self._extend_valid if self.model.bpe else self._extend_best
        at = 0
        while at < len(chars):
            room = max(1, window - len(self.text))
            extend(chars[at : at + room])
            at += room
            if len(self.text) >= window:
                self.commit()

    def _extend_valid(self, chars: str) -> None:
        """Adds, per boundary, the last piece of the one valid path to it."""
        m, back = self.model, self.back
        piece_of, pairs, n, reach, known = m.usable.get, m.pairs, len(m.text_of), m.reach, m.id_of
        end = len(self.text)
        self.text = text = self.text + chars
        for c in chars:
            end += 1
            state = None
            for start in range(end - 1, max(-1, end - reach.get(c, 0) - 1), -1):
                piece = piece_of(text[start:end])
                if piece is not None and back[start] is not None:
                    before = back[start][1]
                    if before < 0 or pairs[before * n + piece]:
                        state = (start, piece, 0.0)
                        break
            if state is None and c not in known and back[end - 1] is not None:
                state = (end - 1, -1, 0.0)
            back.append(state)

    def _extend_best(self, chars: str) -> None:
        """Adds, per boundary, the last piece of the best path to it; the shorter of equals."""
        m, back = self.model, self.back
        end = len(self.text)
        self.text = text = self.text + chars
        for c in chars:
            end += 1
            best = None
            for start in range(end - 1, max(-1, end - m.longest - 1), -1):
                piece = m.id_of.get(text[start:end])
                if piece is not None and back[start] is not None:
                    value = back[start][2] + m.score_of[piece]
                    if best is None or value > best[2]:
                        best = start, piece, value
            if c not in m.id_of and back[end - 1] is not None:
                value = back[end - 1][2] + m.unknown_score
                if best is None or value > best[2]:
                    best = end - 1, -1, value
            back.append(best)

    def _path(self, end: int) -> list[int]:
        out = [end]
        while end > 0:
            end = self.back[end][0]
            out.append(end)
        return out

    def commit(self) -> None:
        """Commit the ids before the last boundary that all surviving paths share."""
        end = len(self.text)
        alive = [k for k in range(max(0, end - self.model.longest + 1), end + 1) if self.back[k] is not None]
        shared = set(self._path(alive[-1]))
        for k in alive[:-1]:
            shared &= set(self._path(k))
        at = max(shared)
        if at == 0:
            return
        self._write(at)
        state = self.back[at]
        self.text = self.text[at:]
        self.back = [(0, state[1], state[2])] + [
            s if s is None else (s[0] - at, s[1], s[2]) for s in self.back[at + 1 :]
        ]

    def _write(self, end: int) -> None:
        out: list[int] = []
        while end > 0:
            start, piece, _ = self.back[end]
            if piece >= 0:
                out.append(piece)
            else:
                out.extend(reversed(self.model.in_bytes(self.text[start:end])))
            end = start
        self.ids.extend(reversed(out))

    def finish(self) -> list[int]:
        self._write(len(self.text))
        return self.ids


def valid_path(model: PieceModel, text: str) -> list[int] | None:
    """The ids of the one valid path through a short text, or None if a character has no piece.

    It takes the longest piece that may follow and turns back where none may: as each
    prefix has one valid path, no boundary is reached twice.
    """
    start_of, pairs, n, length = model.starts.get, model.pairs, len(model.text_of), model.length
    path: list[int] = []
    left: list[list[int]] = []  # per piece of the path, the shorter ones not tried
    at, before, end = 0, -1, len(text)
    while at < end:
        found = []
        for to in range(at + 1, end + 1):
            piece = start_of(text[at:to])
            if piece is None:
                break
            if piece >= 0:
                found.append(piece)
        while True:
            if found:
                piece = found.pop()
                if before < 0 or pairs[before * n + piece]:
                    break
            elif path:
                at -= length[path.pop()]
                found = left.pop()
                before = path[-1] if path else -1
            else:
                return None
        path.append(piece)
        left.append(found)
        at += length[piece]
        before = piece
    return path


class Encoder:
    """Encodes texts, with the ids of short stretches in a bounded cache.

    The cache has two halves: what is found in the older one moves to the newer, which
    takes the older's place when full, so frequent stretches stay.
    """

    def __init__(self, model: PieceModel, limit: int = CACHE_LIMIT):
        self.model, self.limit = model, limit
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def stretch(self, text: str) -> bytes:
        """The ids of a stretch: those of its parts between sure boundaries."""
        out = self.found(text)
        if out is not None:
            return out
        joints = self.model.joints
        cuts = [k for k, pair in enumerate(map(add, text, text[1:]), 1) if pair not in joints]
        if not cuts:
            return self.keep(text, self.search(text))
        parts = [self.part(text[a:b]) for a, b in pairwise([0, *cuts, len(text)])]
        return self.keep(text, b"".join(parts))

    def found(self, text: str) -> bytes | None:
        out = self.cache.get(text)
        if out is None:
            out = self.older.get(text)
            if out is not None:
                self.keep(text, out)
        return out

    def part(self, text: str) -> bytes:
        out = self.found(text)
        return self.keep(text, self.search(text)) if out is None else out

    def search(self, text: str) -> bytes:
        ids = valid_path(self.model, text) if self.model.bpe and len(text) <= MAX_CACHED_CHARS else None
        if ids is None:
            stream = Stream(self.model)
            stream.feed(text)
            ids = stream.finish()
        return pack(f"<{len(ids)}I", *ids)

    def keep(self, text: str, ids: bytes) -> bytes:
        if len(text) <= MAX_CACHED_CHARS:
            if 2 * len(self.cache) >= self.limit:
                self.cache, self.older = {}, self.cache
            self.cache[text] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The text's ids, four bytes each, lowest first."""
        if not text:
            return b""
        escaped = text.replace(" ", ESCAPE)
        if self.model.prefix:
            escaped = ESCAPE + escaped
        if not self.model.cuts:
            return self.stretch(escaped)
        stretches = self.model.stretch.findall(escaped)
        out = list(map(self.cache.get, stretches))
        for k, ids in enumerate(out):
            if ids is None:
                out[k] = self.stretch(stretches[k])
        return b"".join(out)


class Decoder:
    """Turns ids back into text."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.data = [
            bytes([model.byte_of[i]])
            if i in model.byte_of
            else b""
            if i in model.silent
            else p.replace(ESCAPE, " ").encode()
            for i, p in enumerate(model.text_of)
        ]

    def decode(self, ids: bytes) -> str:
        parts = map(self.data.__getitem__, np.frombuffer(ids, "<u4").tolist())
        text = b"".join(parts).decode("utf-8", "replace")
        return text[1:] if self.model.prefix and text.startswith(" ") else text


_LOADED: dict[str, tuple[Encoder, Decoder]] = {}


def _loaded(path: str) -> tuple[Encoder, Decoder]:
    if path not in _LOADED:
        model = PieceModel(path)
        _LOADED[path] = (Encoder(model), Decoder(model))
    return _LOADED[path]


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, text, ids) of every row; ids are four bytes each, lowest first."""
    prepare(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = _loaded(path)
        for batch in batches:
            ids = [encoder.encode(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids, pa.binary())], names=["doc_id", "text", "ids"]
            )

    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text")
    )
    return rows.mapInArrow(encode, "doc_id long, text string, ids binary")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, text, ids) with the decoded text and digests of the ids."""
    prepare(encoded.sparkSession)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = _loaded(path)
        for batch in batches:
            ids = batch.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                    pa.array([decoder.decode(i) for i in ids], pa.string()),
                ],
                names=["doc_id", "text", "n_ids", "ids_crc32", "decoded"],
            )

    return encoded.select("doc_id", "text", "ids").mapInArrow(
        decode, "doc_id long, text string, n_ids long, ids_crc32 long, decoded string"
    )

"""Byte-level BPE over blank-separated pieces with bounded per-worker caches.

A byte-level BPE with the usual pre-tokeniser never merges across a blank that
follows a non-blank, so a text may be cut before each single blank and every
piece encoded on its own. Pieces repeat, so their encodings are kept in a cache
that lives as long as the Python worker; a full cache becomes the older one, from
which pieces still in use come back. A piece of Latin letters alone is one unit of
the pre-tokeniser for sure, so the model encodes it directly. Texts with several blanks in a row are
cut by the pre-tokeniser's own white-space rule instead. The strings of special
tokens inside a text become those tokens, as the library does by default.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

# Unicode White_Space, as the pre-tokeniser's \s (fixed values).
_WS = "\t-\r \x85\xa0" + "".join(
    chr(c) for c in (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)
_CHUNK = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]")

# One unit of the pre-tokeniser: letters of the Latin blocks, which are letters in any Unicode version.
_LETTERS = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")

# Longer pieces are encoded each time: they seldom repeat and would bloat the cache.
MAX_CACHED_CHARS = 48
# Pieces that are put together from others are kept only if they are short.
MAX_CACHED_CUT = 10


def byte_characters() -> str:
    """The character by which byte-level models write each byte: printable ones themselves, the others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return "".join(chr(b if b in printable else next(others)) for b in range(256))


def _direct_model(tokenizer):
    """The tokenizer's model, if its units are the pre-tokeniser's bytes and nothing else changes a text."""
    from tokenizers import models, pre_tokenizers

    split, model = tokenizer.pre_tokenizer, tokenizer.model
    plain = isinstance(model, models.BPE) and isinstance(split, pre_tokenizers.ByteLevel)
    plain = plain and tokenizer.normalizer is None and not split.add_prefix_space and split.use_regex
    return model if plain and not model.dropout else None


class PieceCache(dict):
    """Maps a piece to a value of its ids; misses are encoded, at most ``limit`` beyond the seed are kept.

    Keys are pieces that follow a blank, written without it.
    """

    def __init__(self, tokenizer, value: Callable[[list[int]], object], limit: int, seed=None):
        super().__init__(seed or {})
        self.tokenizer, self.value, self.limit, self.seed = tokenizer, value, limit, seed or {}
        self.room = limit // 2 + len(self.seed)
        self.older: dict = {}
        self.heads: dict = {}
        self.nothing = value([])
        self.model, self.characters = _direct_model(tokenizer), byte_characters()

    def encode(self, text: str):
        if self.model is not None and _LETTERS.fullmatch(text):
            written = text.encode().decode("latin-1").translate(self.characters)
            return self.value([t.id for t in self.model.tokenize(written)])
        return self.value(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, piece: str):
        out, parts = self.older.get(piece), None
        if out is None:
            parts = self._parts(piece)
            if parts is not None:
                left, between, right = parts
                out = self[left] + (self.head(between) if between else self.nothing) + self.head(right)
            else:
                out = self.encode(" " + piece)
        if len(piece) <= (MAX_CACHED_CHARS if parts is None else MAX_CACHED_CUT):
            if len(self) >= self.room:
                self.older = dict(self)
                self.clear()
                self.update(self.seed)
            self[piece] = out
        return out

    def head(self, piece: str):
        """The value of a piece without a blank before it."""
        out = self.heads.get(piece)
        if out is None:
            parts = self._parts(piece)
            if parts is not None:
                left, between, right = parts
                return self.head(left) + (self.head(between) if between else self.nothing) + self.head(right)
            out = self.encode(piece)
            if len(piece) <= MAX_CACHED_CHARS:
                if len(self.heads) >= self.limit // 4:
                    self.heads.clear()
                self.heads[piece] = out
        return out

    @staticmethod
    def _parts(piece: str) -> tuple[str, str, str] | None:
        """A cut that the pre-tokeniser makes for sure: at a lone line break, or before a last stop.

        Pieces beyond such cuts repeat more often.
        """
        i = piece.find("\n")
        if i >= 0:
            if 0 < i < len(piece) - 1 and not piece[i - 1].isspace() and not piece[i + 1].isspace():
                return piece[:i], "\n", piece[i + 1 :]
            return None
        # a letter of the Latin blocks, which are letters in any Unicode version
        if len(piece) > 1 and piece[-1] in ".,;:!?" and piece[-2] < "\u0250" and piece[-2].isalpha():
            return piece[:-1], "", piece[-1]
        return None

    def values_of(self, text: str) -> Iterator:
        """Values of the text's pieces, in order (text without special strings)."""
        if "  " not in text:
            pieces = text.split(" ")
            first = pieces.pop(0)
            if first:
                yield self.head(first)
            yield from map(self.__getitem__, pieces)
            return
        for chunk in _CHUNK.findall(text):
            if chunk[0] == " " and (len(chunk) == 1 or chunk[1] != " "):
                yield self[chunk[1:]]
            else:
                yield self.head(chunk)


def special_strings(tokenizer) -> dict[str, int]:
    """The special tokens that the tokenizer finds inside texts."""
    return {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}


def cut_specials(text: str, specials: dict[str, int], pattern) -> Iterator[tuple[str, int | None]]:
    """(stretch of plain text, id of the special token after it or None at the end)."""
    if not any(s in text for s in specials):
        yield text, None
        return
    at = 0
    for m in pattern.finditer(text):
        yield text[at : m.start()], specials[m[0]]
        at = m.end()
    yield text[at:], None


def special_pattern(specials: dict[str, int]):
    ordered = sorted(specials, key=len, reverse=True)
    return re.compile("|".join(map(re.escape, ordered)) or r"(?!)")


def load(path: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)

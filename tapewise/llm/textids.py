"""Token ids of whole texts, as little-endian unsigned 32-bit integers.

The ids are those of the ``tokenizers`` library.  A byte-level BPE splits a
text before every single space that has a non-blank on either side, whatever
surrounds it, so the ids of the pieces between such spaces can be kept and
reused.  Texts with any other white space next to a space are encoded whole.
A piece of plain words goes word by word straight to the library's merge
model; any other piece goes through its full encoder.
"""

from __future__ import annotations

import re
from array import array

from tapewise.llm.common import by_value, worker_state

#: Pieces and words kept by one worker; a store starts afresh beyond that.
MAX_PIECES = 400_000
MAX_WORDS = 700_000

#: One or two words of Latin letters, each with at most one run of ASCII marks (no apostrophe, which can begin
#: an ending of its own), on one or two lines: the pre-tokenizer cuts such a piece exactly into its words, runs
#: of marks and line end.
_LETTERS, _MARKS = "[A-Za-zÀ-ÖØ-öø-ɏ]+", r"[!-&(-/:-@\[-`{-~]*"
_PLAIN = re.compile(f"({_LETTERS})({_MARKS})(?:(\n)({_LETTERS})({_MARKS}))?")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(spare)) for b in range(256)]


class _Uneven(Exception):
    pass


class _Words(dict):
    """Pre-token in byte letters -> id bytes."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> bytes:
        ids = array("I", [t.id for t in self.model.tokenize(word)]).tobytes()
        if len(word) <= 64:
            if len(self) >= MAX_WORDS:
                self.clear()
            self[word] = ids
        return ids


class _Pieces(dict):
    """Piece (without its space) -> id bytes; unknown pieces are encoded on demand."""

    def __init__(self, tokenizer, limit: int):
        super().__init__()
        self.tokenizer, self.limit = tokenizer, limit
        self.words, self.letters = _Words(tokenizer.model), byte_letters()
        self.space, self.line = self.letters[32], self.letters[10]

    def shown(self, word: str) -> str:
        return word if word.isascii() else "".join([self.letters[b] for b in word.encode()])

    def plain(self, a: str, mark: str, line: str | None, b: str | None, last: str | None) -> bytes:
        ids = self.words[self.space + self.shown(a)]
        if mark:
            ids += self.words[mark]
        if line:
            ids += self.words[self.line] + self.words[self.shown(b)]
            if last:
                ids += self.words[last]
        return ids

    def first(self, head: str) -> bytes:
        """Ids of the piece that begins a text."""
        found = _PLAIN.fullmatch(head)
        if not found or found[3]:
            return raw_ids(self.tokenizer, head)
        ids = self.words[self.shown(found[1])]
        return ids + self.words[found[2]] if found[2] else ids

    def __missing__(self, piece: str) -> bytes:
        found = _PLAIN.fullmatch(piece)
        if found:
            ids = self.plain(*found.groups())
            if found[3]:  # pairs of words across a line end rarely come again
                return ids
        elif not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Uneven
        else:
            ids = raw_ids(self.tokenizer, " " + piece)
        if len(piece) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[piece] = ids
        return ids


def raw_ids(tokenizer, text: str) -> bytes:
    return array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


class Encoder:
    def __init__(self, name: str, limit: int = MAX_PIECES):
        from tokenizers import Tokenizer

        if "/" not in name:
            import public_tokenizers

            name = public_tokenizers.path(name)
        self.tokenizer = Tokenizer.from_file(name)
        self.pieces = _Pieces(self.tokenizer, limit)
        kind = self.tokenizer.pre_tokenizer
        self.splits = self.tokenizer.normalizer is None and "ByteLevel(add_prefix_space=False" in str(kind)

    def encode(self, text: str) -> bytes:
        head, *rest = text.split(" ") if self.splits else [text]
        if not rest:
            return raw_ids(self.tokenizer, text) if text else b""
        if not head or head[-1].isspace():
            return raw_ids(self.tokenizer, text)
        try:
            return self.pieces.first(head) + b"".join(map(self.pieces.__getitem__, rest))
        except _Uneven:
            return raw_ids(self.tokenizer, text)


def encoder(name: str) -> Encoder:
    """The worker's encoder for this tokenizer file (a bare name is looked up among the public tokenizers)."""
    state = worker_state("textids")
    found = getattr(state, "encoders", {})
    if name not in found:
        found[name] = Encoder(name)
        state.encoders = found
    return found[name]


by_value(__name__)

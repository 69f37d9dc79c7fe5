"""Words of a text as token ids, for the two BPE vocabularies of the tokenizers library.

Both split a text before their merges, and a split stands before every ASCII blank that follows a character that is no
blank. So a text may be cut there, and its ids are those of the pieces one after the other. A split also stands
where a run of letters ends. Pieces recur, so each worker remembers the ids of a bounded number of them.
"""

from __future__ import annotations

# Pieces that a worker remembers per vocabulary, and the longest of them.
REMEMBERED = 200_000
LONGEST = 64

# All letters among the first 256 code points. None has a lower case or a composition outside these that text
# of these code points could reach.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"


def octet_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary (a published rule)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Memory:
    """Packed ids of the pieces that a worker met more than once, at most ``REMEMBERED`` of them.

    What was met once only is noted by name, in a set of the same bound; most rare pieces never come again.
    """

    def __init__(self, encoder: Encoder, kind: str):
        """``kind`` is the array type code of the packed ids."""
        from array import array

        self.encoder, self.kind, self.array = encoder, kind, array
        self.known: dict[str, bytes] = {}
        self.once: set[str] = set()

    def packed(self, text: str) -> bytes:
        """Ids of a text, piece by piece."""
        pieces = self.encoder.pieces(text)
        found = list(map(self.known.get, pieces))
        if None in found:
            for i, piece in enumerate(pieces):
                if found[i] is None:
                    found[i] = self._learned(piece)
        return b"".join(found)

    def _learned(self, piece: str) -> bytes:
        packed = self.array(self.kind, self.encoder.ids(piece)).tobytes()
        if len(piece) <= LONGEST:
            if piece in self.once:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[piece] = packed
            else:
                if len(self.once) >= REMEMBERED:
                    self.once.clear()
                self.once.add(piece)
        return packed


class Encoder:
    """Ids of pieces of text as the library's ``encode(piece, add_special_tokens=False)`` gives them.

    A piece of letters only, after a space at most and before common punctuation, is one or two words
    to the merges; these are taken to the library's model directly. Every other piece goes through
    the library's whole ``encode``.
    """

    def __init__(self, path: str):
        import json
        import re

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        spec = json.loads(self.tokenizer.to_str())
        self.lower = spec["normalizer"] is not None
        self.letters = octet_letters()
        self.cut = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+").findall
        # Among the first 256 code points, letters are known, so a run of them is a piece of its own where it begins
        # one. What begins with another character goes on to the next blank, special tokens included.
        blanks = "" if self.lower else r"[ \t-\r]*"
        others = "" if self.lower else r"|[ \t-\r]+"
        self.cut_latin = re.compile(
            rf"{blanks}[{_LETTERS}]+|{blanks}[^ \t-\r{_LETTERS}][^ \t-\r]*{others}"
        ).findall
        # A blank of another kind: before an ASCII blank it must not be cut off.
        self.odd = re.compile(r"[^\S \t-\r]").search
        self.cut_odd = re.compile(r"(?<=\S)(?=[ \t-\r])").split
        self.simple = re.compile(rf"( ?)([{_LETTERS}]+)([.,;:!?]*)").fullmatch
        self.marks: dict[str, list[int]] = {}

    def pieces(self, text: str) -> list[str]:
        """The text in pieces that can be encoded one by one, for a vocabulary of lower case without blanks."""
        if self.odd(text):
            return self.cut_odd(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.cut(text)
        # Lower case makes special tokens out of other text, so a text that may hold one is left as it is.
        return self.cut_latin(text.lower() if self.lower and "<|" not in text else text)

    def whole(self, piece: str) -> list[int]:
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def spelled(self, word: str) -> str:
        return word if word.isascii() and " " not in word else "".join(map(self.letters.__getitem__, word.encode()))

    def ids(self, piece: str) -> list[int]:
        if self.lower and piece.isascii() and piece.isalpha():
            return [t.id for t in self.model.tokenize(piece.lower())]
        found = self.simple(piece)
        if not found:
            return self.whole(piece)
        space, word, marks = found.groups()
        word = word.lower() if self.lower else space + word
        ids = [t.id for t in self.model.tokenize(self.spelled(word))]
        if marks:
            if marks not in self.marks:
                if len(self.marks) > 1000:
                    self.marks.clear()
                self.marks[marks] = self.whole(marks)
            ids += self.marks[marks]
        return ids

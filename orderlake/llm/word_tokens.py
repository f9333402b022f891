"""Ids of the tokenizers library, each distinct word encoded once per task.

The tokenizer drops white space and joins nothing across it, so a text's ids are those
of its words in order. Words are looked up in a table of the task; a word that is not
there is encoded by the library. Words of printable ASCII and Latin letters, nearly all
words of European text, take the library's model directly, as the steps before it are
plain for them; all other words take the whole library pipeline. The table is of bounded
size: when it is full it becomes the old table, from which words in use move on.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterable
from functools import lru_cache

from tokenizers import Tokenizer

#: Entries of a generation of a task's table of words, and of that of pieces of words.
TABLE_SIZE = 250_000
#: Words that need no normalisation but lower case. Latin letters of two bytes only:
#: none of them changes its class or composes with a neighbour.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_SPECIAL = "<|"
#: What most words end in that do not end in a letter.
_TAIL = ".,"
# Fixed value: how the tokenizer splits words, for such letters, after lower-casing.
_SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """Letter that stands for each byte: itself if printable, else the next free one."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class BoundedTable(dict):
    """What ``make`` gives for each key, made once while the key is in use.

    Holds at most two generations of ``size`` entries.
    """

    def __init__(self, make: Callable, size: int) -> None:
        super().__init__()
        self.make, self.size = make, size
        self.old: dict = {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


class WordTable:
    """Encoder of one tokenizer file, with the words seen so far."""

    def __init__(self, tokenizer_file: str, size: int = TABLE_SIZE) -> None:
        self.library = Tokenizer.from_file(tokenizer_file)
        self.words = BoundedTable(self._word, size)
        self.pieces = BoundedTable(self._piece, size)
        self.letters = {ord(chr(b)): c for b, c in _byte_letters().items()}
        self._require_form(tokenizer_file)

    def _require_form(self, tokenizer_file: str) -> None:
        """The short ways above hold for tokenizers of this form only."""
        with open(tokenizer_file, encoding="utf-8") as file:
            form = json.load(file)
        steps = [x["type"] for x in form["normalizer"]["normalizers"]]
        splits = form["pre_tokenizer"]["pretokenizers"]
        if (
            steps != ["NFC", "Replace", "Lowercase"]
            or [x["type"] for x in splits] != ["Split", "ByteLevel"]
            or splits[0]["pattern"] != {"Regex": _SPLIT_PATTERN}
            or form["post_processor"] is not None
            or not all(_SPECIAL in x["content"] for x in form["added_tokens"])
        ):
            raise ValueError("this tokenizer does not split at white space as expected")

    def _piece(self, piece: str) -> bytes:
        # Each byte of UTF-8 stands as a letter of its own; ASCII stands for itself.
        said = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [token.id for token in self.library.model.tokenize(said)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        # Most words are letters, maybe with a full stop or a comma behind them.
        bare = text.rstrip(_TAIL)
        if bare.isalpha() and (bare.isascii() or _PLAIN.fullmatch(bare)):
            piece = self.pieces[bare.lower()]
            return piece if bare == text else piece + self.pieces[text[len(bare) :]]
        if not _PLAIN.fullmatch(text) or _SPECIAL in text:
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.pieces.__getitem__, _PIECES.findall(text.lower())))

    def encode_all(self, texts: Iterable[bytes | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null is empty."""
        of = self.words.__getitem__
        # bytes.split() splits at ASCII white space, which the tokenizer drops.
        return [b"".join(map(of, text.split())) if text else b"" for text in texts]


@lru_cache(maxsize=2)
def word_table(tokenizer_file: str) -> WordTable:
    """The table of this Python worker."""
    return WordTable(tokenizer_file)

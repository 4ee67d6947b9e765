"""Token ids of whole texts, from the ``tokenizers`` library.

Both public vocabularies cut a text into pieces that never span certain white
space, and encode each piece on its own. ``Encoder`` therefore cuts a text at
such places, has the library normalize, cut and encode every distinct chunk
once per worker, and joins the ids. Texts that hold the string of a special
token, or rare control characters, go to the library whole. The tests hold the
joined ids against a plain ``Tokenizer.encode`` of the full text.
"""

from __future__ import annotations

import os
import re
from array import array

#: Distinct chunks kept per worker process, and the longest chunk kept; beyond
#: the first bound the memory of the worker is freed and filled again.
MAX_CHUNKS, MAX_CHUNK_CHARS = 600_000, 48

_OTHER_SPACE = re.compile(r"[^\S \n]|[ \n][ \n]")
_UNITS = re.compile(r"\s?\S+|\s+(?=\s\S)|\s+$")
_ODD_SPACE = "\x1c\x1d\x1e\x1f\x85\u180e\u200b"
#: Marks that both vocabularies keep apart from the letters before them.
_MARKS = ".,!?%&*$#|;:)"
_LOADED: dict[tuple[str, str], "Encoder"] = {}


def byte_level_chunks(text: str) -> list[str]:
    """Cut before each white-space character that a non-space follows: the
    byte-level pattern always starts a new piece there."""
    if "\0" in text or _OTHER_SPACE.search(text):
        return _UNITS.findall(text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")


def word_chunks(text: str) -> list[str]:
    """Cut at white space, which the word vocabulary drops."""
    return text.split()


class _Alphabet(dict):
    """Each character as the library's byte-level alphabet writes it."""

    def __init__(self):
        from tokenizers.pre_tokenizers import ByteLevel
        super().__init__()
        self.write = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str

    def __missing__(self, code: int) -> str:
        self[code] = "".join(p for p, _ in self.write(chr(code)))
        return self[code]


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, cut: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.pieces = self.tokenizer.model, self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.normal = self.tokenizer.normalizer.normalize_str if self.tokenizer.normalizer else str
        self.cut = {"byte_level": byte_level_chunks, "words": word_chunks}[cut]
        self.lower = cut == "words"
        self.alphabet = _Alphabet()
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = re.compile("|".join(re.escape(t.content) for t in added), re.IGNORECASE)
        assert all(t.content.startswith("<|") for t in added)
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str, cut: str) -> "Encoder":
        """One encoder per worker process and vocabulary."""
        if (path, cut) not in _LOADED:
            _LOADED[path, cut] = cls(path, cut)
        return _LOADED[path, cut]

    def _word(self, word: str) -> bytes:
        """Ids of one run of letters (with its leading space, if any)."""
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) > MAX_CHUNKS:
                self.words.clear()
            tokens = self.model.tokenize(word.translate(self.alphabet))
            ids = self.words[word] = array("I", [t.id for t in tokens]).tobytes()
        return ids

    def _chunk(self, chunk: str) -> bytes:
        """A run of letters, or one followed by marks: one piece each. Any
        other chunk is normalized and cut by the library."""
        word = chunk.rstrip(_MARKS)
        marks = chunk[len(word):]
        if self.lower:
            word = word.lower() if word.isascii() else self.normal(word)
        if len(word) <= MAX_CHUNK_CHARS and (word[1:] if word[:1] == " " else word).isalpha():
            return self._word(word) + (self._marks(marks) if marks else b"")
        return self._pieces(chunk)

    def _marks(self, marks: str) -> bytes:
        if marks not in self.tails:
            self.tails[marks] = self._pieces(marks)
        return self.tails[marks]

    def _pieces(self, chunk: str) -> bytes:
        pieces = [p for p, _ in self.pieces(self.normal(chunk))]
        return array("I", [t.id for p in pieces for t in self.model.tokenize(p)]).tobytes()

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text (null: none), without any end id."""
        if not text:
            return b""
        if "<|" in text and self.special.search(text) or any(c in text for c in _ODD_SPACE):
            return self._whole(text)
        chunks = self.cut(text)
        if len(self.known) > MAX_CHUNKS:
            self.known.clear()
        out, at = list(map(self.known.get, chunks)), -1
        try:
            while True:
                at = out.index(None, at + 1)
                chunk = chunks[at]
                ids = out[at] = self.known.get(chunk) or self._chunk(chunk)
                if len(chunk) <= MAX_CHUNK_CHARS:
                    self.known[chunk] = ids
        except ValueError:  # none is left
            return b"".join(out)

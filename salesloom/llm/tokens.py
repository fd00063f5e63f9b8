"""Token ids of whole texts with a public tokenizer file, looked up piece by piece."""

from __future__ import annotations

import re
from struct import pack

import numpy as np

# A piece ends before a space that follows a non-space; byte-level BPE never joins across such a place.
# Texts with other uses of the space, white space followed by a space, are encoded as a whole.
_WHOLE = re.compile(r"\s ")

# Fixed values of byte-level BPE, for printable ASCII, tab, line ends and the letters from U+00C0 to U+00FF: a word
# is a contraction, letters, digits or marks with the space before them, or white space.
_PLAIN = re.compile(r"[\x20-\x7e\t\n\rÀ-ÖØ-öø-ÿ]*")
_WORDS = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-z0-9À-ÖØ-öø-ÿ]+|\s+(?!\S)|\s+")


def _letters() -> dict[int, str]:
    """How the model writes the characters of plain pieces: bytes that are no visible Latin-1 character are
    numbered on from letter 256."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0x100)} - {0xAD}
    hidden = [byte for byte in range(256) if byte not in visible]
    letter = {byte: chr(byte) for byte in visible} | {byte: chr(256 + n) for n, byte in enumerate(hidden)}
    return {c: "".join(letter[byte] for byte in chr(c).encode()) for c in [*range(0x80), *range(0xC0, 0x100)]}


_LETTERS = _letters()
_SPECIAL = "<|"


class TextEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids; equal pieces are encoded once.

    ``most`` bounds the pieces remembered for good, half as many words besides;
    the others are remembered for about ``stretch`` characters, which are taken
    apart at a time.  The ids are those of the library on the whole text.
    """

    def __init__(self, path: str, most: int = 400_000, stretch: int = 2_000_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Ids by piece: of pieces that begin a text, of pieces after a space (kept without it), of words.
        self.first: dict[str, bytes] = {"": b""}
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.most = most
        self.stretch = stretch

    def _encoded(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for start in range(0, len(texts), 4096):
            found = self.tokenizer.encode_batch_fast(texts[start : start + 4096], add_special_tokens=False)
            out.extend(np.array(encoding.ids, "<u4").tobytes() for encoding in found)
        return out

    def _by_words(self, piece: str) -> bytes:
        """The ids of a piece of plain characters, word by word through the tokenizer's model."""
        out = []
        for word in _WORDS.findall(piece):
            ids = self.words.get(word)
            if ids is None:
                found = [token.id for token in self.tokenizer.model.tokenize(word.translate(_LETTERS))]
                ids = pack("<%dI" % len(found), *found)
                if len(self.words) < self.most // 2:
                    self.words[word] = ids
            out.append(ids)
        return b"".join(out)

    def _pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of each piece.

        Plain pieces go word by word.  Other pieces of a space and more, the
        last character no white space, are encoded many in a row and parted by
        their places; the rest one by one.
        """
        found = {
            piece: self._by_words(piece) for piece in pieces if _PLAIN.fullmatch(piece) and _SPECIAL not in piece
        }
        pieces = [piece for piece in pieces if piece not in found]
        alone = [piece for piece in pieces if len(piece) < 2 or piece[0] != " " or piece[1].isspace() or piece[-1].isspace()]
        found.update(zip(alone, self._encoded(alone)))
        rest = [piece for piece in pieces if piece not in found]
        for start in range(0, len(rest), 4096):
            row = rest[start : start + 4096]
            encoding = self.tokenizer.encode("".join(row), add_special_tokens=False)
            ids = np.array(encoding.ids, "<u4")
            places = np.array([place[0] for place in encoding.offsets])
            ends = np.searchsorted(places, np.cumsum([len(piece) for piece in row]), "left").tolist()
            data, last = ids.tobytes(), 0
            for piece, end in zip(row, ends):
                found[piece] = data[4 * last : 4 * end]
                last = end
        return found

    def _learned(self, known: dict[str, bytes], wanted: set[str], before: str) -> dict[str, bytes]:
        """A table with the ids of all ``wanted``: ``known`` itself as long as it has room."""
        new = wanted.difference(known)
        if not new:
            return known
        found = self._pieces([before + piece for piece in new])
        now = {piece[len(before):]: ids for piece, ids in found.items()}
        if len(known) + len(now) <= self.most:
            known.update(now)
            return known
        now.update((piece, known[piece]) for piece in wanted.difference(now) if piece in known)
        return now

    def _ids(self, texts: list[str]) -> list[bytes]:
        # Every piece but the first of a text carries the space before it.
        pieces = [text.split(" ") for text in texts]
        starts, rest = set(), set()
        for own in pieces:
            starts.add(own[0])
            rest.update(own[1:])
        first = self._learned(self.first, starts, "")
        known = self._learned(self.known, rest, " ").__getitem__
        return [b"".join([first[own[0]], *map(known, own[1:])]) for own in pieces]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        out: list[list[bytes]] = [[] for _ in texts]
        places: list[int] = []
        stretches: list[str] = []
        size = 0
        for n, text in enumerate(texts):
            if not text:
                continue
            if _WHOLE.search(text):
                out[n].extend(self._encoded([text]))
                continue
            start = 0
            while start < len(text):
                # A long text is parted before a space, where no token reaches across.
                end = text.find(" ", start + self.stretch)
                end = len(text) if end < 0 else end
                places.append(n)
                stretches.append(text[start:end])
                size += end - start
                start = end
                if size >= self.stretch:
                    for place, ids in zip(places, self._ids(stretches)):
                        out[place].append(ids)
                    places, stretches, size = [], [], 0
        for place, ids in zip(places, self._ids(stretches)):
            out[place].append(ids)
        return [b"".join(ids) for ids in out]


_encoders: dict[tuple[str, int], TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """The encoder of this Python process."""
    import os

    key = (path, os.getpid())
    if key not in _encoders:
        _encoders[key] = TextEncoder(path)
    return _encoders[key]


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)

"""Token ids of whole texts by the tokenizers library, with a bounded memory of chunks already encoded."""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

from tokenizers import Tokenizer

#: A space before which a byte-level pre-token always begins: one that a printable ASCII character or a Latin-1
#: letter follows. A run of white space gives its last space to the next word and is cut before it.
_CUT = re.compile(rb"(?= [!-~\xc3])")
#: White space other than single spaces and line feeds between words: its UTF-8, or the lead bytes it begins with.
_ODD = (b"  ", b"\n\n", b" \n", b"\n ", b"\t", b"\r", b"\x0b", b"\x0c", b"\x1c", b"\x1d", b"\x1e", b"\x1f",
        b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a", b"\xe1\xa0", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80", b"\xef\xbb")
#: A full stop or comma that does not follow an ASCII letter or digit or a Latin-1 letter, and may thus stand inside a
#: pre-token. The others begin one, and are made chunks of their own.
_INSIDE = re.compile(rb"[.,](?<![0-9A-Za-z].)(?<!\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].)")
#: ASCII marks, and a letter (ASCII or Latin-1) at the end of a word.
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_LETTER = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])\Z")
#: Words that are one pre-token: ASCII or Latin-1 letters.
_PLAIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+\Z")
#: The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = [b for b in range(256) if b not in _PRINTED]
_BYTE = {b: 256 + i for i, b in enumerate(_OTHERS)}


class Encoder(dict):
    """ids as little-endian unsigned 32-bit bytes: ``encode(text) == ids of the whole text``.

    No pre-token crosses the cuts below, so a text's ids are those of its chunks in a row. The library encodes a chunk
    when it is first seen; the mapping remembers it, for at most 2 * ``room`` chunks, the older half being dropped.
    A text that holds the string of a special token, in any case, goes to the library whole: the token is cut out of
    the text before any other rule applies.
    """

    def __init__(self, path: str, byte_level: bool, room: int = 600_000):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile(b"|".join(map(re.escape, added)) or rb"(?!)", re.IGNORECASE)
        self.mark = min(added, key=len)[:2] if len({a[:2] for a in added}) == 1 and added[0][:2].upper() == added[0][:2].lower() else b""
        self.pieces, self.space = self.tokenizer.model.tokenize, "\u0120" if byte_level else ""
        self.byte_level, self.room = byte_level, room
        self.before = b"\xff" if byte_level else b""
        self.coded = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.old: dict[bytes, bytes] = {}

    def _chunks(self, text: bytes) -> list[bytes]:
        """Chunks; in byte-level mode those without \xff in front have a space there."""
        apart = not _INSIDE.search(text)
        if not self.byte_level:
            if apart:
                text = text.replace(b".", b" .").replace(b",", b" ,")
            return text.lower().split()  # A-Z only; the tokenizer lowers the rest
        if text[0] in b" \n" or text[-1] in b" \n" or any(x in text for x in _ODD):
            return [c[1:] if c[:1] == b" " else b"\xff" + c for c in _CUT.split(text)]
        if apart:
            text = text.replace(b".", b" \xff.").replace(b",", b" \xff,")
        return (b"\xff" + text.replace(b"\n", b" \xff\n \xff")).split(b" ")

    def _word(self, word: str) -> bytes:
        """A word that is one pre-token, in the characters that stand for its bytes: its ids are the model's own."""
        coded = self.coded
        return b"".join([coded[t.id] for t in self.pieces(self.space + word)])

    def _encoded(self, chunk: bytes) -> bytes:
        if _PLAIN.match(chunk):  # the lower-casing tokenizer's normaliser does no more than that to these letters
            letters = chunk if self.byte_level else chunk.decode().lower().encode()
            return self._word(letters.decode("latin-1").translate(_BYTE))
        word = chunk.rstrip(_MARKS)
        if word != chunk and _LETTER.search(word):  # a word and the marks after it are separate pre-tokens
            return self[word] + self[self.before + chunk[len(word):]]
        if self.byte_level:
            text = (chunk[1:] if chunk[:1] == b"\xff" else b" " + chunk).decode()
        else:
            text = chunk.decode()
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            ids = self._word(chunk.decode()) if chunk.isalpha() else self._encoded(chunk)
        if len(self) >= self.room:
            self.old = dict(self)
            self.clear()
        self[chunk] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        if self.mark in text and self.special.search(text):
            return array("I", self.tokenizer.encode(text.decode(), add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.__getitem__, self._chunks(text))) if text else b""


@lru_cache(maxsize=2)
def encoder(path: str, byte_level: bool) -> Encoder:
    """One encoder for each Python worker: the memory lasts from task to task."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task its cores
    return Encoder(path, byte_level)

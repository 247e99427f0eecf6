"""Exact BPE ids of whole texts at dictionary speed.

Both vocabularies split a text before any merge, and no split reaches across
the cuts made here, so the ids of a text are the ids of its chunks one after
the other. Chunks repeat a great deal; their ids are kept in a bounded
dictionary per Python worker, and only unseen chunks reach the tokenizer.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import re
from array import array

import pyarrow as pa

#: what the tokenizers' own patterns call white space (Unicode White_Space)
_SPACE = "\t-\r \x85\xa0" + "".join(map(chr, [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: chunks for a vocabulary that keeps white space: a run of other characters
#: with the one space before it; a run of white space up to its last
#: character; a last white space character that is no space
_KEEPING = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]")
#: chunks for a vocabulary that drops white space
_DROPPING = re.compile(f"[^{_SPACE}]+")
#: str.split() cuts at these as well, the tokenizers don't
_ONLY_PYTHON = re.compile("[\x1c-\x1f]")

#: letters, or letters with signs after them; both vocabularies split between the two
_WORD_AND_SIGNS = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")
_LETTERS_AND_SIGNS = re.compile(_WORD_AND_SIGNS.pattern.replace("( ?", "(", 1))
#: byte-level vocabularies show a byte as its own character if that is a
#: visible one of Latin-1, else as the next free character from 256 on
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_LEVEL = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}
#: what a character of ``_WORD_AND_SIGNS``' letters looks like byte by byte
_SHOWN = {chr(c): chr(c).encode().decode("latin-1").translate(_BYTE_LEVEL) for c in range(256)}

#: entries of a dictionary generation; two generations are held
CACHE_ENTRIES = 400_000
CACHE_CHARS = 64


def release() -> None:
    """Give memory that a worker's earlier tasks have freed back to the system:
    the allocators keep it, and an executor's memory is one budget."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class _Generations(dict):
    """A bounded dictionary: when it is full it becomes the older generation,
    from which what is still asked for moves up again. A worker holds one at a
    time: it runs one task, and the next operator's tasks need the memory."""

    active: _Generations | None = None

    def __init__(self, make, entries: int = CACHE_ENTRIES) -> None:
        super().__init__()
        self.make, self.entries, self.older = make, entries, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > CACHE_CHARS:
                return value
        self[key] = value
        return value

    def trim(self) -> None:
        """Between two texts: keep to the bound."""
        if _Generations.active is not self:
            _Generations.drop()
            _Generations.active = self
        if len(self) > self.entries:
            self.older = dict(self)
            self.clear()

    @classmethod
    def drop(cls) -> None:
        """Before work that needs no words."""
        if cls.active is not None:
            cls.active.clear()
            cls.active.older = {}
            cls.active = None
        release()


class Encoder:
    """``encode(text)`` gives the ids of a whole text as little-endian bytes,
    two bytes an id if the vocabulary fits, else four. No special tokens are
    added; where a text holds the string of one, that is its id, as the library
    has it, and the text before and after is encoded by itself. (Machines that
    Spark runs on are little-endian, as ``array`` then is.)"""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.dtype = "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.drops_space = tokenizer.normalizer is not None
        self.normalize = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
        self.split, self.merge = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model.tokenize
        self.code = "H" if self.dtype == "<u2" else "I"
        self.chunks = _Generations(self._chunk if self.drops_space else self._after_space)
        special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.special = {text: array(self.code, [i]).tobytes() for text, i in special.items()}
        #: the longest beginning that all of them share
        self.mark = os.path.commonprefix([*special]) if special else None
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")

    def _chunk(self, chunk: str) -> bytes:
        parts = _WORD_AND_SIGNS.fullmatch(chunk)
        if parts:
            word, signs = parts.groups()
            if signs:
                return self.chunks[self._key(word)] + self.chunks[self._key(signs)]
            # one piece, in normal form but for its case
            if self.drops_space and not chunk.islower():
                return self.chunks[chunk.lower()]
            if chunk.isascii():
                return self._ids(chunk.replace(" ", _SHOWN[" "]))
            return self._ids("".join(map(_SHOWN.__getitem__, chunk)))
        return b"".join([self._ids(piece) for piece, _ in self.split(self.normalize(chunk))])

    def _key(self, chunk: str) -> str:
        """Where a vocabulary keeps white space, a chunk with a space before it
        goes by what follows the space, any other chunk by itself behind one."""
        if self.drops_space:
            return chunk
        return chunk[1:] if chunk[0] == " " and not chunk[-1].isspace() else " " + chunk

    def _after_space(self, key: str) -> bytes | None:
        """Ids of a key. None for white space that the next space may join."""
        parts = _LETTERS_AND_SIGNS.fullmatch(key)
        if parts:
            word, signs = parts.groups()
            if signs:
                return self.chunks[word] + self.chunks[" " + signs]
            return self._ids(_SHOWN[" "] + (word if word.isascii() else "".join(map(_SHOWN.__getitem__, word))))
        if key[:1] == " ":
            text = key[1:]
        elif not key or key[-1].isspace():
            return None
        else:
            text = " " + key
        chunks = _KEEPING.findall(text)
        if len(chunks) != 1:
            return b"".join(map(self.chunks.__getitem__, map(self._key, chunks)))
        return self._chunk(text)

    def _ids(self, piece: str) -> bytes:
        return array(self.code, [t.id for t in self.merge(piece)]).tobytes()

    def encode(self, text: str) -> bytes:
        if self.mark is not None and self.mark in text:
            parts = self.at_special.split(text)
            return b"".join([self.special.get(part) or self._plain(part) for part in parts if part])
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if not self.drops_space:
            self.chunks.trim()
            # a space after anything but white space is always a cut
            parts = text.split(" ")
            if len(parts) > 1:
                parts[-1] = "  " + parts[-1]
            parts[0] = " " + parts[0]
            try:
                return b"".join(map(self.chunks.__getitem__, parts))
            except TypeError:  # a None among them
                return b"".join(map(self.chunks.__getitem__, map(self._key, _KEEPING.findall(text))))
        elif _ONLY_PYTHON.search(text):
            parts = _DROPPING.findall(text)
        else:
            parts = text.split()
        self.chunks.trim()
        return b"".join(map(self.chunks.__getitem__, parts))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary, loaded once per process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]

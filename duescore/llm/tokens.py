"""Token ids of whole texts by a byte-level BPE vocabulary, with a cache of chunks.

A text is cut into chunks at places that are always borders of the vocabulary's
pre-tokens, so the ids of a text are the ids of its chunks in order, and a chunk is
encoded once however often it occurs:

* before a space that a printable ASCII character or a two-byte letter follows
  (in a run of white space, the last space goes to the next word);
* before ASCII punctuation, save apostrophes, after an ASCII letter or digit;
* before an ASCII letter after a single line feed that follows printable ASCII.

A text that holds one of the vocabulary's added tokens is encoded whole.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from duescore.llm.common import text_buffer

#: Chunks kept per Python worker (about 150 bytes each) before the cache starts anew.
CACHE_CHUNKS = 250_000


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _marks(*spans: tuple[int, int], without: bytes = b"") -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in spans:
        out[a : b + 1] = True
    out[list(without)] = False
    return out


AFTER_SPACE = _marks((0x21, 0x7E), (0xC3, 0xDF))
PRINTABLE = _marks((0x21, 0x7E))
LETTER = _marks((0x41, 0x5A), (0x61, 0x7A))
LETTER_DIGIT = _marks((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))
PUNCTUATION = _marks((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E), without=b"'")


class Encoder:
    """Encodes columns of texts; one per Python worker and vocabulary file."""

    _made: dict[tuple[str, bool], Encoder] = {}

    def __init__(self, path: str, added: bool = True):
        """``added``: the strings of added tokens are those tokens; else ordinary text."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        # Bytes of each id: the vocabulary writes a byte as one character.
        vocabulary = self.tokenizer.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.width[i] = len(token)
        self.cache: dict[bytes, int] = {}
        self._empty()

    @classmethod
    def of(cls, path: str, added: bool = True) -> Encoder:
        if (path, added) not in cls._made:
            cls._made[path, added] = cls(path, added)
        return cls._made[path, added]

    def _empty(self) -> None:
        self.cache.clear()
        self.flat = np.zeros(1 << 20, np.uint32)
        self.start = np.zeros(1 << 18, np.int64)
        self.size = np.zeros(1 << 18, np.int64)
        self.used = 0

    def _learn(self, chunks: list[bytes]) -> None:
        """Puts the ids of new chunks into the cache.  Chunks that start with a space,
        and those that start with a letter once a line feed is put before them, may
        follow any other one without changing its pre-tokens, so they are encoded as
        one text and told apart by the lengths of the ids' bytes."""
        spaced, lettered, other = [], [], []
        for c in chunks:
            if len(c) > 1 and c[0] == 0x20 and AFTER_SPACE[c[1]]:
                spaced.append(c)
            elif LETTER[c[0]]:
                lettered.append(c)
            else:
                other.append(c)
        for kind, part in ((b"", spaced), (b"\n", lettered)):
            for at in range(0, len(part), 20_000):
                group = part[at : at + 20_000]
                ids = np.array(self.tokenizer.encode((kind + kind.join(group)).decode(), add_special_tokens=False).ids, np.uint32)
                size = np.fromiter(map(len, group), np.int64, len(group)) + len(kind)
                to = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum(size)) + 1
                begin = np.r_[0, to[:-1]] + len(kind)  # without the id of the line feed
                self._store(group, ids, begin, to - begin)
        if other:
            ids = [e.ids for e in self.tokenizer.encode_batch_fast([c.decode() for c in other], add_special_tokens=False)]
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            self._store(other, np.fromiter((i for x in ids for i in x), np.uint32, size.sum()), np.cumsum(size) - size, size)

    def _store(self, chunks: list[bytes], ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        n = len(self.cache)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(chunks) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[n : n + len(chunks)] = self.used + begin
        self.size[n : n + len(chunks)] = size
        self.used += len(ids)
        self.cache.update(zip(chunks, range(n, n + len(chunks))))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text's ids); null is empty."""
        data, offsets = text_buffer(texts)
        n = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        now, nxt = data[:-1], data[1:]
        cut = np.zeros(len(data) + 1, bool)
        cut[:-2] |= (now == 0x20) & AFTER_SPACE[nxt]
        cut[1:-1] |= LETTER_DIGIT[now] & PUNCTUATION[nxt]
        cut[2:-1] |= PRINTABLE[data[:-2]] & (now[1:] == 0x0A) & LETTER[nxt[1:]]
        cut[offsets] = True
        cut[-1] = False
        bounds = np.append(np.flatnonzero(cut), len(data))
        arr = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        coded = arr.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.cache) > CACHE_CHUNKS:
            self._empty()
        get = self.cache.get
        self._learn([c for c in distinct if c not in self.cache])
        slot = np.fromiter((get(c) for c in distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        size = self.size[slot]
        chunk_to = np.cumsum(size)
        place = np.repeat(self.start[slot] - (chunk_to - size), size)
        place += np.arange(len(place))
        ids = self.flat[place]
        row = np.concatenate([[0], chunk_to])[np.searchsorted(bounds, offsets)]
        return self._whole(texts, data, ids, row)

    def _whole(self, texts: pa.Array, data: np.ndarray, ids: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encodes anew, as one piece, the texts that hold an added token."""
        raw = data.tobytes()
        if not any(a.encode() in raw for a in self.added):
            return ids, row
        parts = [ids[a:b] for a, b in zip(row, row[1:])]
        for k, t in enumerate(texts.to_pylist()):
            if t and any(a in t for a in self.added):
                parts[k] = np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

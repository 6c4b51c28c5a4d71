"""Token ids of many texts with a word-level BPE of the tokenizers library.

The vocabulary never merges across white space, so a text's ids are those of its
blank-separated words.  A block of texts is split and its distinct words found
by Arrow; only words that the worker does not know yet go through the library,
and Arrow puts the known words' ids in the texts' order.
"""

from __future__ import annotations

from functools import lru_cache
from typing import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from statlens.llm.textvec import FOLD, slices

#: Bytes of text that a worker tokenises at once (a longer text is one block).
TEXT_BLOCK = 8 << 20


class WordTokenizer:
    """Token ids of texts as little-endian uint32, with those of word parts kept from block to block.

    Plain words (Latin letters, then maybe a run of ASCII punctuation without an
    apostrophe) skip the file's normaliser and splitter, which change only their
    case and part the run from the letters; all others take the whole tokenizer.
    """

    #: Keys and bytes of one generation of kept keys; the one before it is kept too.
    KEPT, KEPT_BYTES = 400_000, 16 << 20

    def __init__(self, path: str, kept: int = KEPT):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.whole.model)  # the same model without the file's normaliser and splitter
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.whole.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.kept: dict[bytes, bytes] = {b"": b""}
        self.before: dict[bytes, bytes] = {}
        self.most, self.bytes = kept, 0

    def _learn(self, keys: list[bytes], odd: np.ndarray) -> None:
        """Keep the ids of distinct ``keys``, from the generation before or from the library (the whole tokenizer where ``odd``)."""
        if len(self.kept) > self.most or self.bytes > self.KEPT_BYTES:
            self.before, self.kept, self.bytes = self.kept, {b"": b""}, 0
        whole = {keys[k] for k in np.flatnonzero(odd).tolist()}
        missing = set(keys).difference(self.kept)
        new = missing.difference(self.before)
        self.kept.update((x, self.before[x]) for x in missing.difference(new))
        self.bytes += sum(map(len, new))
        plain = list(new.difference(whole))
        for i in range(0, len(plain), 512):
            part = plain[i:i + 512]
            ids = np.array(self.bare.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, "<u4")
            raw, cuts = ids.tobytes(), ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            assert len(cuts) == len(part)
            self.kept.update(zip(part, [raw[a:b] for a, b in zip([0, *cuts], cuts)]))
        other = list(new.intersection(whole))
        for i in range(0, len(other), 512):
            part = other[i:i + 512]
            for x, e in zip(part, self.whole.encode_batch_fast([x.decode() for x in part], add_special_tokens=False)):
                self.kept[x] = np.array(e.ids, "<u4").tobytes()

    def _ids(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words without white space."""
        parts, odd = word_parts(words)
        parts = parts.dictionary_encode()
        n = len(parts.dictionary)
        keys = pc.binary_join(pa.ListArray.from_arrays([0, n], parts.dictionary), b"\n")[0].as_py().split(b"\n")
        at = parts.indices.to_numpy()
        whole = np.zeros(n, bool)
        whole[at[1::2][odd]] = True
        self._learn(keys, whole)
        ids = pa.array(list(map(self.kept.__getitem__, keys)), pa.binary()).take(parts.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int32, len(ids) + 1, ids.offset * 4)
        return pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(np.ascontiguousarray(ends[::2])), ids.buffers()[2]])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, end of each text's ids); ``texts`` (strings) has no null."""
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        if not len(words):
            return np.zeros(0, "<u4"), np.zeros(len(texts), np.int64)
        ids = self._ids(words.dictionary).take(words.indices)
        at = np.frombuffer(ids.buffers()[1], np.int32, len(ids) + 1, ids.offset * 4)
        data = np.frombuffer(ids.buffers()[2] or b"", "<u4", (int(at[-1]) - int(at[0])) // 4, int(at[0]))
        last = split.offsets.to_numpy()[1:] - split.offsets[0].as_py()
        return data, (at[last] - at[0]) // 4


_byte = np.arange(256)
#: A-Z and a-z; the second bytes of Latin-1 letters, of capitals among them; ASCII punctuation but the apostrophe.
_ASCII = (_byte | 32 >= 97) & (_byte | 32 <= 122) & (_byte < 128)
_SECOND = (_byte >= 0x80) & (_byte <= 0xBF) & (_byte != 0x97) & (_byte != 0xB7)
_CAPITAL = _SECOND & (_byte < 0x9F)
_MARK = (_byte >= 33) & (_byte <= 126) & (_byte != 39) & ~_ASCII & ~((_byte >= 48) & (_byte <= 57))


def word_parts(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Two parts of each word, A-Z and Latin-1 capitals lower-cased, and which words are not plain.

    A plain word's parts are its letters and its punctuation, maybe empty; another
    word's are nothing and the whole word.
    """
    n = len(words)
    at = np.frombuffer(words.buffers()[1], np.int32, n + 1, words.offset * 4)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8, int(at[-1]) - int(at[0]), int(at[0]))
    at = at - at[0]
    second = np.zeros(len(data) + 1, bool)
    second[1:-1] = (data[:-1] == 0xC3) & _SECOND[data[1:]]
    letter = _ASCII[data] | second[:-1] | second[1:]
    low = FOLD[data]
    low += (second[:-1] & _CAPITAL[data]).view(np.uint8) << 5
    other = np.append(np.flatnonzero(~letter), len(data))
    lead = np.minimum(other[np.searchsorted(other, at[:-1])], at[1:]) - at[:-1]
    marks = np.concatenate([[0], np.cumsum(_MARK[data])])
    odd = (lead == 0) | (lead + marks[at[1:]] - marks[at[:-1]] != np.diff(at))
    cut = np.empty(2 * n + 1, np.int32)
    cut[::2], cut[1::2] = at, at[:-1] + np.where(odd, 0, lead)
    return pa.Array.from_buffers(pa.binary(), 2 * n, [None, pa.py_buffer(cut), pa.py_buffer(low)]), odd


@lru_cache(maxsize=1)
def word_tokenizer(name: str, kept: int = WordTokenizer.KEPT) -> WordTokenizer:
    """The tokenizer that a Python worker keeps from task to task; ``kept``: keys of one generation."""
    import public_tokenizers

    return WordTokenizer(public_tokenizers.path(name), kept)


def text_blocks(batches: Iterable[pa.RecordBatch], column: str, limit: int = TEXT_BLOCK) -> Iterator[pa.RecordBatch]:
    """The batches' rows in blocks of about ``limit`` bytes of ``column`` (a longer text is a block by itself)."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        sizes = pc.binary_length(b.column(column)).to_pylist()
        for s in slices(sizes, limit):
            own, n = b.slice(s.start, s.stop - s.start), sum(sizes[s])
            if held and size + n > limit:
                yield pa.concat_batches(held)
                held, size = [], 0
            held.append(own)
            size += n
    if held:
        yield pa.concat_batches(held)
    pa.default_memory_pool().release_unused()  # the worker may wait long for its next task

"""Token ids of whole texts by a public tokenizer, a batch at a time.

Words repeat, so each distinct word of a batch is tokenised once and the ids
are put back in text order by Arrow and numpy; no Python object is made for a
word.  What was tokenised before is kept in a table, two Arrow arrays, that is
bounded by bytes and belongs to one task: it goes when the task ends.
"""

from __future__ import annotations

import os
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerspark.llm.common import give_back

#: bytes of the table "letters or other word -> ids" of one task; a full
#: table is emptied
TABLE_BYTES = 8 << 20
#: bytes of text split into words at a time
SLICE = 2 << 20
#: words joined by blanks for one call of the tokenizer
AT_ONCE = 500
# letters that no normalisation joins with what follows, then ASCII punctuation
_PLAIN = r"^(?P<core>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[!-/:-@\[-`{-~]*)$"

if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are written as this machine holds them: little-endian, 32 bits")


@lru_cache(maxsize=2)
def _loaded(path: str) -> tuple:
    """The tokenizer, another one for lower-case runs of letters or of
    punctuation, and what must be replaced in texts for that one.

    Loaded once in a process: the library keeps some megabytes of every
    tokenizer that has been used, even when the object is gone.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers

    model = Tokenizer.from_file(path)
    # such a run needs no normalising and no splitting: the model itself takes
    # it, written in its byte alphabet; that has the letter of the same number
    # for most bytes of these letters
    alphabet = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    moved = []
    for letter in map(chr, range(0xDF, 0x100)):
        pairs = zip(letter.encode().decode("latin-1"), alphabet.pre_tokenize_str(letter)[0][0], strict=True)
        moved += [(x, y) for x, y in pairs if x != y and (x, y) not in moved]
    runs = Tokenizer(model.model)
    runs.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    return model, runs, moved


class WordTokenizer:
    """Ids of whole texts, each distinct white-space-free word tokenised once.

    Valid for tokenizers that lower-case, drop ASCII white space, never merge
    across it and keep letters and punctuation apart; ``word_bpe_49k`` is one.
    """

    def __init__(self, path: str):
        self.model, self.runs, self.moved = _loaded(path)
        self._empty()

    def _empty(self) -> None:
        """A table that knows the empty word only."""
        self.words, self.word_ids = pa.array([""], pa.string()), pa.array([b""], pa.large_binary())
        self.size = 0

    def _known(self, keys: pa.StringArray, single: bool) -> pa.LargeBinaryArray:
        """Ids of each of these distinct keys; ``single``: keys are lower-case
        runs of letters or of punctuation, so the tokenizer sees one word in
        each."""
        place = pc.index_in(keys, value_set=self.words)
        missing = place.is_null()
        new = keys.filter(missing)
        if not len(new):
            return self.word_ids.take(place)
        ids = self._tokenised(new, single)
        both = pa.concat_arrays([self.word_ids, ids])
        unknown = np.asarray(missing)
        at = np.asarray(place.fill_null(0)).astype(np.int64)
        at[unknown] = len(self.words) + np.arange(len(new))
        size = new.nbytes + ids.nbytes
        if self.size + size <= TABLE_BYTES:
            self.words, self.word_ids = pa.concat_arrays([self.words, new]), both
            self.size += size
        else:
            self._empty()
            if size <= TABLE_BYTES:
                self.words = pa.concat_arrays([self.words, new])
                self.word_ids = pa.concat_arrays([self.word_ids, ids])
                self.size = size
        return both.take(pa.array(at))

    def _tokenised(self, keys: pa.StringArray, single: bool) -> pa.LargeBinaryArray:
        """Ids of each key by the tokenizer."""
        begins = [*range(0, len(keys), AT_ONCE), len(keys)]
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(begins, pa.int32()), keys), " ").to_pylist()
        flat, counts = array("I"), []
        if single:
            for k, text in enumerate(texts):
                if not text.isascii():
                    text = text.encode().decode("latin-1")
                    for x, y in self.moved:
                        text = text.replace(x, y)
                one = self.runs.encode(text, add_special_tokens=False)
                flat.extend(one.ids)
                counts.append(np.bincount(one.word_ids, minlength=begins[k + 1] - begins[k]))
        else:
            sizes = np.asarray(pc.utf8_length(keys)).astype(np.int64)
            for k, text in enumerate(texts):
                one = self.model.encode(text, add_special_tokens=False)
                flat.extend(one.ids)
                ends = np.cumsum(sizes[begins[k] : begins[k + 1]] + 1)
                starts = np.fromiter((a for a, _ in one.offsets), dtype=np.int64, count=len(one.ids))
                counts.append(np.diff(np.searchsorted(starts, ends), prepend=0))
        offsets = np.concatenate(([0], 4 * np.cumsum(np.concatenate(counts), dtype=np.int64)))
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(keys), [None, pa.py_buffer(offsets), pa.py_buffer(flat.tobytes())]
        )

    def _word_ids(self, words: pa.StringArray) -> pa.BinaryArray:
        """The ids of each of these distinct words."""
        parts = pc.extract_regex(words, _PLAIN)
        plain = parts.is_valid()
        some = parts.filter(plain)
        pieces = []
        for name in ("core", "tail"):
            coded = pc.dictionary_encode(pc.utf8_lower(some.field(name)))
            pieces.append(self._known(coded.dictionary, True).take(coded.indices))
        joined = pc.binary_join_element_wise(*pieces, pa.scalar(b"", pa.large_binary()))
        both = pa.concat_arrays([joined, self._known(words.filter(pc.invert(plain)), False)])
        # back to the order of `words`
        mask = np.asarray(plain)
        place = np.where(mask, np.cumsum(mask) - 1, len(joined) + np.cumsum(~mask) - 1)
        return both.take(pa.array(place))

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.ascii_split_whitespace(texts)
        coded = pc.dictionary_encode(split.flatten())
        ids = self._word_ids(coded.dictionary)
        lengths = np.diff(np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)) // 4 if len(ids) else np.empty(0, int)
        indices = np.asarray(coded.indices)
        if len(indices):
            data = np.frombuffer(ids.take(coded.indices).buffers()[2] or b"", "<u4")
        else:
            data = np.empty(0, "<u4")
        ends = np.concatenate(([0], np.cumsum(lengths[indices], dtype=np.int64)))
        return data[: ends[-1]], ends[np.asarray(split.offsets) - split.offsets[0].as_py()]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, offsets): text i has the
        unsigned 32-bit ids [offsets[i], offsets[i + 1])."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        sizes = np.cumsum(np.asarray(pc.binary_length(texts), dtype=np.int64))
        all_ids, offsets, at = [], [np.zeros(1, np.int64)], 0
        total = 0
        while at < len(texts):
            before = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, before + SLICE, side="right")))
            data, ends = self._slice(texts.slice(at, to - at))
            all_ids.append(data)
            offsets.append(total + ends[1:])
            total += int(ends[-1])
            at = to
        return (np.concatenate(all_ids) if all_ids else np.empty(0, "<u4")), np.concatenate(offsets)


def closed_ids(model: WordTokenizer, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """``model.ids`` with ``end_id`` after each text."""
    data, offsets = model.ids(texts)
    return (
        np.insert(data, offsets[1:], np.uint32(end_id)).astype("<u4", copy=False),
        offsets + np.arange(len(offsets)),
    )


def tokenized(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The rows of the batches (column ``text``), about SLICE bytes of text at
    a time, with their texts' ids and their offsets."""
    give_back()  # what other work left in this worker
    model = WordTokenizer(path)
    for batch in _dealt(batches):
        yield batch, *closed_ids(model, batch.column("text"), end_id)
    del model
    give_back()


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in the same order; small batches together (the table is
    searched once for all their words), large ones in parts."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.binary_length(batch.column("text")).fill_null(0)), dtype=np.int64)
        at = 0
        while at < len(batch):
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + SLICE - size, side="right")))
            held.append(batch.slice(at, to - at))
            size += int(ends[to - 1]) - before
            at = to
            if at < len(batch) or 2 * size >= SLICE:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)

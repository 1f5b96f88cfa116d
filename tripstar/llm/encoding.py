"""Token ids of whole texts, by the tokenizers library, with caches of words that tasks of a worker share."""

from __future__ import annotations

import operator
import os
import string
import sys
import types
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Entries of the caches of a worker; about 150 bytes each.
CACHE_WORDS, CACHE_STEMS = 700_000, 400_000
_SEPARATOR = "<|endoftext|>"
# Letters that may stand in a stem lie below this code point.
_STEM_LIMIT = 0x250


def safe_letters(tokenizer) -> dict[int, str]:
    """Code point -> lower case, of the letters on the allow-list: single, unchanged by NFC and lowered to
    one letter by the tokenizer's own normalizer as by Python. No letter of it combines with another."""
    safe = {}
    for code in range(_STEM_LIMIT):
        c = chr(code)
        low = c.lower()
        if c.isalpha() and len(low) == 1 and unicodedata.is_normalized("NFC", c) and tokenizer.normalizer.normalize_str(c) == low:
            safe[code] = low
    return safe


class _Numbers(dict):
    """Numbers words as they are looked up; those met since the last call of :meth:`taken` wait in a list."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number

    def taken(self) -> list[bytes]:
        new, self.new = self.new, []
        return new


class _Pool:
    """Ids of the words one after another, each word by its number: two numbers a word and no object."""

    def __init__(self, dtype: np.dtype):
        self.ids, self.ends, self.n = np.zeros(1 << 16, dtype), np.zeros(1 << 16, np.int64), 0

    def add(self, parts: list[bytes]) -> None:
        """The ids of the words with the next numbers."""
        size = self.ids.itemsize
        first = int(self.ends[self.n])
        ends = first + np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts))) // size
        self.ids, self.ends = _room(self.ids, int(ends[-1])), _room(self.ends, self.n + len(parts) + 1)
        self.ids[first:ends[-1]] = np.frombuffer(b"".join(parts), self.ids.dtype)
        self.ends[self.n + 1:self.n + 1 + len(parts)] = ends
        self.n += len(parts)

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these words and how many each has."""
        first = self.ends[numbers]
        sizes = self.ends[numbers + 1] - first
        ends = np.cumsum(sizes)
        at = np.repeat(first - ends + sizes, sizes)
        at += np.arange(len(at))
        return self.ids[at], sizes


def _values(words: pa.Array) -> list[bytes]:
    """The words of a string column without white space; one join and one split instead of an object of Arrow's per word."""
    if not len(words):
        return []
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "\n")
    return joined.cast(pa.binary())[0].as_py().split(b"\n")


def _room(array: np.ndarray, n: int) -> np.ndarray:
    """The array, or a larger copy if it has less than ``n`` places."""
    return array if n <= len(array) else np.concatenate([array, np.zeros(max(n, 2 * len(array)) - len(array), array.dtype)])


class WordTokenizer:
    """Token ids of whole texts from bounded caches of words and of word stems.

    A word is a run without ASCII white space, which the tokenizer drops; nothing is composed, merged or
    matched across it, so a text's ids are those of its words. Other white space, control characters and
    special tokens' strings stay inside their word, which the tokenizer encodes itself. Only a word of
    letters on the allow-list (:func:`safe_letters`) followed by ASCII punctuation is taken apart: it has
    the ids of its lower-case stem, then those of the punctuation. Unseen punctuation and other words of a
    batch are encoded together, joined by a special token unless a part holds its opening. The normalizer leaves
    a stem as it is and the pattern of the pre-tokenizer takes it whole, so stems are joined by spaces and
    go to the library without both; the token that ends a stem has the model's end-of-word suffix."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.separator = self.tokenizer.token_to_id(_SEPARATOR)
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.dtype = np.dtype("<u4" if self.wide else "<u2")
        self.letters = safe_letters(self.tokenizer)
        self.stem_tokenizer = Tokenizer(self.tokenizer.model)
        self.stem_tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)  # tokens that end a word
        self.last[[i for t, i in self.tokenizer.get_vocab().items() if suffix and t.endswith(suffix)]] = True
        self.words = _Numbers()
        self.pool = _Pool(self.dtype)  # by the word's number
        self.stems: dict[str, bytes] = {}

    def _parts(self, words: list[bytes]) -> tuple[list[str], list[str]]:
        """The lower-case stem of every word and the punctuation after it; "" and the word for other words."""
        joined = b"\n".join(words).decode()
        unsafe = {c for c in set(joined) if c.isalpha() and ord(c) not in self.letters}
        whole = joined.split("\n")
        lower = [w.rstrip(string.punctuation) for w in joined.lower().split("\n")] if not unsafe else \
            ["" if unsafe.intersection(w) else w.lower().rstrip(string.punctuation) for w in whole]
        stems = [x if x.isalpha() else "" for x in lower]
        return stems, [w[len(x):] for w, x in zip(whole, stems, strict=True)]

    def _learn(self, words: list[bytes]) -> None:
        stems, ends = self._parts(words)
        known = self.stems
        known[""] = b""
        new = list(set(stems).difference(known))
        other = [] if self._learn_stems(new) else new
        other += set(ends).difference(known, other)
        alone = [x for x in other if "<|" in x]
        if alone:
            other = [x for x in other if "<|" not in x]
        chunks = [other[at:at + 500] for at in range(0, len(other), 500)]
        for chunk, one in zip(chunks, self.tokenizer.encode_batch_fast([_SEPARATOR.join(c) for c in chunks], add_special_tokens=False), strict=True):
            ids = np.array(one.ids, dtype=self.dtype)
            cuts = np.flatnonzero(ids == self.separator)
            self._keep(chunk, ids, [0, *cuts + 1], [*cuts, len(ids)])
        for x in alone:
            known[x] = np.array(self.tokenizer.encode(x, add_special_tokens=False).ids, dtype=self.dtype).tobytes()
        get = known.__getitem__
        self.pool.add([*map(operator.add, map(get, stems), map(get, ends))])

    def _learn_stems(self, stems: list[str]) -> bool:
        """False if the ends of the stems cannot be told in their tokens."""
        chunks = [stems[at:at + 500] for at in range(0, len(stems), 500)]
        for chunk, one in zip(chunks, self.stem_tokenizer.encode_batch_fast([" ".join(c) for c in chunks], add_special_tokens=False), strict=True):
            ids = np.array(one.ids, dtype=self.dtype)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(chunk) or ends[-1] != len(ids):
                return False
            self._keep(chunk, ids, [0, *ends[:-1]], ends)
        return True

    def _keep(self, parts: list[str], ids: np.ndarray, begins, ends) -> None:
        raw, size = ids.tobytes(), self.dtype.itemsize
        self.stems.update(zip(parts, [raw[x:y] for x, y in zip((np.array(begins) * size).tolist(), (np.array(ends) * size).tolist(), strict=True)], strict=True))

    def encode_flat(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a string column one after another and how many each text has; none for a null.
        Each text's are followed by ``end_id`` if that is given."""
        if len(self.words) > CACHE_WORDS:
            self.words, self.pool = _Numbers(), _Pool(self.dtype)
        if len(self.stems) > CACHE_STEMS:
            self.stems.clear()
        # split at ASCII white space alone; white space at an end of a text leaves an empty word there, which has no ids
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        found = split.flatten().dictionary_encode()
        numbers = np.fromiter(map(self.words.__getitem__, _values(found.dictionary)), np.int64, len(found.dictionary))
        if new := self.words.taken():
            self._learn(new)
        ids, sizes = self.pool.take(numbers[found.indices.to_numpy()])
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(split.value_lengths().to_numpy())]
        counts = np.diff(ends, prepend=0)
        if end_id is not None:
            ids, counts = np.insert(ids, ends, end_id), counts + 1
        return ids, counts

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of each text, as bytes of ``dtype``; none for a null."""
        return id_bytes(*self.encode_flat(pa.array(texts, pa.binary()).cast(pa.string()))).to_pylist()


def id_bytes(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Ids that lie one after another, as one binary value per text."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * ids.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids)]).cast(pa.binary())


def process_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this Python worker with its caches. Task code is unpickled anew for each task, so
    they are kept in a module of their own that lives as long as the worker."""
    # tasks are the parallelism; threads of the library would only contend with them
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    kept = sys.modules.setdefault("tripstar_llm_worker", types.ModuleType("tripstar_llm_worker")).__dict__
    if path not in kept:
        kept[path] = WordTokenizer(path)
    return kept[path]

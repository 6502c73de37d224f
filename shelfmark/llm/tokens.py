"""Token ids of whole texts by a public tokenizer, one encoding per distinct word."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The longest list of words a worker keeps encodings of.
CACHED_WORDS = 400_000
_SEPARATOR = "\x01"


class WordTokenizer:
    """Ids of texts under a tokenizer that lower-cases and drops white space.

    Such a tokenizer treats the stretches between white space, and a run of
    letters and the ASCII punctuation after it, independently, so the texts are
    cut there, each distinct word is encoded once, and the ids are put together
    by position.  Texts with a special token's string are encoded whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.separator = self.encode(_SEPARATOR)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, self.dtype)
        self.bounds = np.zeros(1, np.int64)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)

    def _learn(self, words: list[str]) -> None:
        """Encode words that are not known yet, many to a string with a separator between."""
        plain = [w for w in words if _SEPARATOR not in w] if len(self.separator) == 1 else []
        odd = [w for w in words if _SEPARATOR in w] if plain else words
        groups = [f" {_SEPARATOR} ".join(plain[k : k + 256]) for k in range(0, len(plain), 256)]
        parts = [self.ids]
        sizes = [np.diff(self.bounds)]
        for encoded in self.tokenizer.encode_batch_fast(groups, add_special_tokens=False):
            ids = np.array(encoded.ids, self.dtype)
            ends = np.flatnonzero(ids == self.separator[0])
            parts.append(np.delete(ids, ends))
            sizes.append(np.diff(np.concatenate([[-1], ends, [len(ids)]])) - 1)
        for word in odd:
            parts.append(self.encode(word))
            sizes.append([len(parts[-1])])
        for word in (*plain, *odd):
            self.known[word] = len(self.known)
        self.ids = np.concatenate(parts)
        self.bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes).astype(np.int64))])

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of each text's ids, and the ids of all texts; a null has none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = np.zeros(len(texts), bool)
        for special in self.specials:
            whole |= pc.match_substring(texts, special, ignore_case=True).to_numpy(zero_copy_only=False)
        cut = pc.replace_substring_regex(
            pc.ascii_lower(pc.if_else(pa.array(whole), "", texts)),
            pattern=r"(\pL)([!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~])",
            replacement=r"\1 \2",
        )
        lists = pc.ascii_split_whitespace(cut)
        coded = lists.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) + len(distinct) > CACHED_WORDS:
            self._forget()
        fresh = [w for w in distinct if w not in self.known]
        if fresh:
            self._learn(fresh)
        numbers = np.fromiter((self.known[w] for w in distinct), np.int64, len(distinct))
        numbers = numbers[coded.indices.to_numpy(zero_copy_only=False)] if len(distinct) else numbers
        starts, sizes = self.bounds[numbers], np.diff(self.bounds)[numbers]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        flat = self.ids[np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])]
        words = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
        bounds = ends[words.astype(np.int64)]
        if not whole.any():
            return bounds, flat
        each = [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        for row in np.flatnonzero(whole):
            each[row] = self.encode(texts[int(row)].as_py())
        return np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int64), np.concatenate(each)


_OPEN: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this worker; its encodings outlive a task."""
    if path not in _OPEN:
        _OPEN[path] = WordTokenizer(path)
    return _OPEN[path]

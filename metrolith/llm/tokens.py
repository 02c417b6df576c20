"""Token ids of whole texts with a public word tokenizer, word by word with a memory.

Only for tokenizers that drop white space and whose tokens never cross it, so that a text's ids are the ids of
its words in a row; ``word_bpe_49k.json`` is one.  The ids are those of ``Tokenizer.encode(text,
add_special_tokens=False)`` of the tokenizers library.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from metrolith.llm import common
from metrolith.llm.memory import SpanMemory, distinct, gather, texts_of

MODEL = "word_bpe_49k.json"
END_ID = 1
_KIND = np.uint32


def model_path(name: str = MODEL) -> str:
    """A model's file: an absolute path as it is, else a file of the installed public tokenizers."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokens:
    """Ids of words, by the library, remembered."""

    def __init__(self, name: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.model = Tokenizer.from_file(model_path(name))
        self.model.no_truncation()
        self.model.no_padding()
        self.size = self.model.get_vocab_size(with_added_tokens=True)
        self.encode = getattr(self.model, "encode_batch_fast", self.model.encode_batch)
        self.memory = SpanMemory(self.ids, _KIND)

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat: list[int] = []
        sizes: list[int] = []
        for a in range(0, len(words), 10_000):
            for e in self.encode(words[a : a + 10_000], add_special_tokens=False):
                found = e.ids
                flat += found
                sizes.append(len(found))
        return np.array(flat, _KIND), np.array(sizes, np.int64)


_MODELS: dict[str, WordTokens] = {}


def model(name: str = MODEL) -> WordTokens:
    if name not in _MODELS:
        _MODELS[name] = WordTokens(name)
    return _MODELS[name]


class Tokens:
    """The ids of a column of texts: ``ids`` of all texts in a row, and n+1 offsets."""

    def __init__(self, column: pa.Array, name: str = MODEL, end_id: int | None = END_ID):
        w = common.scan_words(column)
        self._code, first = distinct(w.data, w.starts, w.ends, w.hashes)
        second = common.hash_spans(w.data, w.starts[first], w.ends[first], second=True)
        self._flat, self._start, self._size = model(name).memory.find(w.hashes[first], second, lambda rows: texts_of(w.data, w.starts[first[rows]], w.ends[first[rows]]))
        self._end = end_id
        n_words = np.concatenate(([0], np.cumsum(self._size[self._code])))
        self.offsets = n_words[w.offsets] + (0 if end_id is None else 1) * np.arange(len(w.offsets))
        self.text_of_word = common.owner_of(w.offsets)

    def ids(self) -> np.ndarray:
        size = self._size[self._code]
        value = gather(self._flat, self._start[self._code], size)
        if self._end is None:
            return value
        out = np.empty(int(self.offsets[-1]), _KIND)
        out[self.offsets[1:] - 1] = self._end
        out[np.arange(len(value)) + np.repeat(self.text_of_word, size)] = value
        return out

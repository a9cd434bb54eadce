"""Public tokenizers inside Spark tasks.

A tokenizer's vocabulary file is read where the job is started, from a path that is a parameter,
and its bytes go to the tasks; a file has one fixed size of a few megabytes. A task builds the
tokenizer once per Python worker.

Text is encoded by segments. Each tokenizer here splits text before it merges, and none merges
across a border between segments, so that the ids of a text are those of its segments in order.
Equal segments are encoded once and remembered per worker, within fixed bounds of number and size;
what is remembered does not change a result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

REMEMBERED = 200_000
LONGEST = 64

# White space that splits texts of tokenizers that drop it.
SPACES = r"[ \t\n\r]+"

Value = TypeVar("Value")


class Memory:
    """Values of segments; missing ones are made together, a batch at a time.

    Two generations are kept. When the younger is full it becomes the older one, whose segments
    return to the younger as they are used again: rare segments leave, frequent ones stay.
    """

    def __init__(self, make: Callable[[list[str]], list[Value]]) -> None:
        self.make = make
        self.young: dict[str, Value] = {}
        self.old: dict[str, Value] = {}

    def values(self, segments: Iterable[str]) -> dict[str, Value]:
        """The values of the given segments; equal ones may be named more than once."""
        found = dict.fromkeys(segments)
        missing = []
        for one in found:
            value = self.young.get(one) or self.old.get(one)
            if value is None:
                missing.append(one)
            else:
                found[one] = value
        found.update(zip(missing, self.make(missing)))
        for one, value in found.items():
            if len(one) <= LONGEST:
                if len(self.young) >= REMEMBERED // 2:
                    self.old, self.young = self.young, {}
                self.young[one] = value
        return found


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


@lru_cache(maxsize=4)
def json_tokenizer(vocabulary: bytes, special_as_text: bool):
    """A tokenizer of the tokenizers library, from the bytes of its JSON file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary.decode("utf-8"))
    tokenizer.encode_special_tokens = special_as_text
    return tokenizer


def encode_all(tokenizer, texts: list[str]) -> list[list[int]]:
    return [found.ids for found in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class WordEncoder:
    """Ids of many texts at once, for a tokenizer that drops white space.

    Texts are split into words at blanks, tabs and line ends, and the words made distinct behind
    those already known, all in Arrow. Only new words reach Python: they are encoded together, a
    NUL between them, whose id stands for nothing else where no word holds a NUL.
    """

    SLICE_BYTES = 8_000_000
    KNOWN_WORDS, KNOWN_BYTES = 1_000_000, 32_000_000
    TOGETHER = 500
    of_vocabulary: dict[bytes, WordEncoder] = {}

    def __init__(self, vocabulary: bytes) -> None:
        self.tokenizer = json_tokenizer(vocabulary, False)
        self.border = encode_all(self.tokenizer, ["\x00"])[0]
        self._forget()

    @classmethod
    def of_worker(cls, vocabulary: bytes) -> WordEncoder:
        if vocabulary not in cls.of_vocabulary:
            cls.of_vocabulary[vocabulary] = cls(vocabulary)
        return cls.of_vocabulary[vocabulary]

    def _forget(self) -> None:
        self.words = pa.array([], pa.string())
        self.ids = np.zeros(0, dtype=np.uint32)  # of all known words
        self.sizes = np.zeros(0, dtype=np.int32)  # ids per known word

    def _learn(self, words: list[str]) -> None:
        """Appends the ids of new words to those of the known ones."""
        ids, sizes = [self.ids], [self.sizes]
        for start in range(0, len(words), self.TOGETHER):
            some = words[start : start + self.TOGETHER]
            if len(self.border) == 1 and "\x00" not in "".join(some):
                (found,) = encode_all(self.tokenizer, [" \x00 ".join(some)])
                numbers = np.array(found, dtype=np.uint32)
                borders = np.flatnonzero(numbers == self.border[0])
                sizes.append((np.diff(borders, prepend=-1, append=len(numbers)) - 1).astype(np.int32))
                ids.append(np.delete(numbers, borders))
            else:
                each = encode_all(self.tokenizer, some)
                sizes.append(np.array([len(one) for one in each], dtype=np.int32))
                ids += [np.array(one, dtype=np.uint32) for one in each]
        self.ids, self.sizes = np.concatenate(ids), np.concatenate(sizes)

    def encode(self, texts: pa.Array, end_id: int) -> Iterator[list[np.ndarray]]:
        """Per slice of texts, none null, the unsigned 32-bit ids of each and ``end_id`` behind them."""
        ends = np.cumsum(pc.binary_length(texts).to_numpy()) // self.SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(texts)]
        for start, stop in zip(cuts, cuts[1:]):
            if start < stop:
                yield self._slice(texts[start:stop], end_id)

    def _slice(self, texts: pa.Array, end_id: int) -> list[np.ndarray]:
        if len(self.words) > self.KNOWN_WORDS or self.words.nbytes > self.KNOWN_BYTES:
            self._forget()
        split = pc.split_pattern_regex(texts, SPACES)
        n_known = len(self.words)
        both = pa.concat_arrays([self.words, split.flatten()]).dictionary_encode()
        self.words = both.dictionary  # the known words come first
        self._learn(self.words[n_known:].to_pylist())
        which = both.indices[n_known:].to_numpy()
        lengths = self.sizes[which]
        ends = np.cumsum(lengths, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        # place of each id in ``self.ids``: the first of its word, and on from there
        first = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        places = np.repeat(first[which] - ends + lengths, lengths)
        places += np.arange(total)
        borders = np.concatenate([[0], ends])[np.asarray(split.offsets) - split.offsets[0].as_py()]
        flat = np.insert(self.ids[places], borders[1:], np.uint32(end_id))
        cuts = (borders + np.arange(len(borders))).tolist()
        return [flat[i:j] for i, j in zip(cuts, cuts[1:])]


@lru_cache(maxsize=4)
def piece_tokenizer(vocabulary: bytes):
    """A sentencepiece tokenizer, from the bytes of its model file."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=vocabulary)


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte, to the byte.

    Printable Latin-1 letters stand for themselves, the other bytes, in order, for 256, 257, …
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def json_token_bytes(vocabulary: bytes) -> list[bytes]:
    """Per id its bytes, of a byte-level vocabulary."""
    letters = byte_letters()
    tokenizer = json_tokenizer(vocabulary, True)
    names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    return [
        bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
        for name in names
    ]


@lru_cache(maxsize=4)
def piece_token_bytes(vocabulary: bytes) -> list[bytes]:
    """Per id its bytes: U+2581 is a blank, <0xHH> one byte."""
    model = piece_tokenizer(vocabulary)
    return [
        bytes([int(model.id_to_piece(i)[3:-1], 16)])
        if model.is_byte(i)
        else model.id_to_piece(i).replace("▁", " ").encode()
        for i in range(model.get_piece_size())
    ]


# Where a blank that starts a word follows the end of another one. U+2581 stands for a blank in
# piece vocabularies, U+180E was white space in older tables: no border beside either.
WORD_BORDER = re.compile(r"(?<=[^\s▁᠎])(?= [^\s▁᠎])")

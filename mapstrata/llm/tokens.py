"""Token ids of texts by a public tokenizer file, with a cache of words per Python worker."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from mapstrata.llm.words import worker_state

MOST_CACHED = 250_000
AT_ONCE = 4 << 20  # bytes of texts, or one text, that are encoded together
INNER_SPACE = re.compile(r"(?<!\s) (?!\s)")
MARKS = ".,;:!?#*$%&|"
DELIMITER = "\u010a"  # stands for a line break in the byte-level alphabet; no word of letters holds it
# Letters up to here are letters in every version of Unicode.
LAST_LETTER = "\u024f"


def byte_characters() -> dict[int, str]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)}


class _Words(dict):
    """Ids, as bytes, of words with ``prefix`` before them; None for words that touch other white space.
    Holds two generations of ``most`` words and forgets the older one when the younger is full."""

    def __init__(self, owner: ByteLevelEncoder, prefix: str, most: int) -> None:
        super().__init__()
        self.owner, self.prefix, self.most, self.older = owner, prefix, most, {}
        self.lead = prefix.translate(owner.alphabet)

    def __missing__(self, word: str) -> bytes | None:
        value = self.older.get(word)
        if value is None:
            value = self._encoded(word)
            if value is None:
                return None
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[word] = value
        return value

    def _encoded(self, word: str) -> bytes | None:
        if word.isalpha():
            if word.isascii():  # these letters stand for themselves in the model
                return self.owner.spelled(self.lead + word)
            if max(word) <= LAST_LETTER:
                return self.owner.letters(self.prefix + word)
        if not word or word[0].isspace() or word[-1].isspace():
            return None
        head = word.rstrip(MARKS)
        if head and head != word and head[-1].isalpha() and head[-1] <= LAST_LETTER:
            marks = self.owner.first[word[len(head) :]]  # a run of marks after a letter is a token of its own
            stem = self[head]
            return None if stem is None else stem + marks
        if "\n" in word:
            lines = word.split("\n")
            parts = [self[lines[0]], *(self.owner.first[x] for x in lines[1:])]
            return self.owner.library(self.prefix + word) if None in parts else self.owner.newline.join(parts)
        return self.owner.library(self.prefix + word)

    def many(self, words: list[str]) -> list[bytes | None]:
        """The same of many distinct words: those of letters that are not held yet are encoded together."""
        values = list(map(self.get, words))
        missing = [word for word, value in zip(words, values) if value is None]
        found = dict(zip(missing, map(self.older.get, missing)))
        fresh = [word for word, value in found.items() if value is None and word.isalpha()]
        plain = [word for word in fresh if word.isascii()]
        found.update(zip(plain, self.owner.spelled_all([self.lead + word for word in plain])))
        others = [self.prefix + word for word in fresh if not word.isascii() and max(word) <= LAST_LETTER]
        spelled = "\n".join(others).encode().decode("latin-1").translate(self.owner.alphabet).split(DELIMITER) if others else []
        found.update(zip([word[len(self.prefix) :] for word in others], self.owner.spelled_all(spelled)))
        rest = {word: self._encoded(word) for word, value in found.items() if value is None}
        found.update(rest)
        if len(self) + len(found) > self.most:
            self.older = dict(self)
            self.clear()
        self.update(found)
        for word, value in rest.items():
            if value is None:
                del self[word]
        return [found[word] if value is None else value for word, value in zip(words, values)]

    def marked(self, words: pa.Array) -> list[bytes | None]:
        """The same of an Arrow array of distinct words. Words that differ in the marks behind them are looked up once."""
        stems = pc.utf8_rtrim(words, MARKS).dictionary_encode()
        names = stems.dictionary.to_numpy(zero_copy_only=False).tolist()
        known, codes = self.many(names), stems.indices.to_numpy()
        with_marks = np.flatnonzero(pc.binary_length(words).to_numpy() != pc.binary_length(stems.dictionary).to_numpy()[codes])
        codes = codes.tolist()
        values = [known[code] for code in codes]
        first = self.owner.first
        for at, word in zip(with_marks.tolist(), words.take(pa.array(with_marks)).to_numpy(zero_copy_only=False).tolist()):
            head = names[codes[at]]
            if head[-1:].isalpha() and head[-1] <= LAST_LETTER:
                values[at] = None if values[at] is None else values[at] + first[word[len(head) :]]
            else:
                values[at] = self[word]
        return values


class ByteLevelEncoder:
    """Encodes with a byte-level BPE file of the tokenizers library, without special tokens.

    Its splitting never joins a visible character with a space or line break that follows it, nor a letter with a mark
    that follows it. So a text may be cut at single spaces and single line breaks between visible characters and before
    a word's last marks, and each part is encoded once per worker. Words of letters go to the library's BPE model,
    other parts to the whole tokenizer. ``many`` takes an Arrow array of texts: parts are split and told apart in Arrow,
    and new words of letters go to the model in one call.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = Tokenizer(self.model)
        self.words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(DELIMITER)
        tokens = self.tokenizer.get_vocab(with_added_tokens=False)
        self.lengths = np.zeros(max(tokens.values(), default=0) + 1, np.int64)
        self.lengths[list(tokens.values())] = [len(token) for token in tokens]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        code = "H" if self.dtype.itemsize == 2 else "I"
        self.packers = [struct.Struct(f"<{n}{code}").pack for n in range(64)]
        self.alphabet = {chr(b): c for b, c in byte_characters().items()}
        self.alphabet = str.maketrans(self.alphabet)
        self.newline = self.library("\n")
        self.first = _Words(self, "", MOST_CACHED // 5)
        self.spaced = _Words(self, " ", MOST_CACHED)

    def _packed(self, ids: list[int]) -> bytes:
        return self.packers[len(ids)](*ids) if len(ids) < len(self.packers) else np.array(ids, self.dtype).tobytes()

    def library(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def letters(self, word: str) -> bytes:
        """Ids of a word of letters, which is one part to the tokenizer."""
        return self.spelled(word.encode().decode("latin-1").translate(self.alphabet))

    def spelled(self, word: str) -> bytes:
        """The same of a word in characters of the byte-level alphabet."""
        return self._packed([token.id for token in self.model.tokenize(word)])

    def spelled_all(self, words: list[str]) -> list[bytes]:
        """The same of many words in one call of the BPE model; the lengths of the tokens tell where each one ends."""
        if not words:
            return []
        ids = np.array(self.words.encode_batch_fast([DELIMITER.join(words)], add_special_tokens=False)[0].ids, np.int64)
        ends, wanted = np.cumsum(self.lengths[ids]), np.cumsum([len(word) for word in words])
        last = np.searchsorted(ends, wanted)
        if not len(ends) or ends[-1] != wanted[-1] or (ends[last] != wanted).any():  # characters that the model does not know
            return [self.spelled(word) for word in words]
        held, stops = ids.astype(self.dtype).tobytes(), ((last + 1) * self.dtype.itemsize).tolist()
        return [held[a:b] for a, b in zip([0, *stops[:-1]], stops)]

    def many(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of every text of an Arrow array, in order. Of the texts of a slice each distinct part is looked up once."""
        texts = pc.fill_null(texts, "")
        sizes = pc.binary_length(texts).to_numpy()
        slices = (np.cumsum(sizes, dtype=np.int64) - sizes) // AT_ONCE
        begins = np.flatnonzero(np.diff(slices, prepend=-1)).tolist()
        for begin, end in zip(begins, [*begins[1:], len(texts)]):
            yield from self._together(texts.slice(begin, end - begin))

    def _together(self, texts: pa.Array) -> Iterator[bytes]:
        # a line break begins a part of its own; parts that touch other white space leave their text to __call__
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        begins, parts = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten().dictionary_encode()
        words, codes = parts.dictionary, parts.indices.to_numpy()
        heads = words.take(pa.array(codes[begins[:-1]])).to_numpy(zero_copy_only=False).tolist()
        line = pc.starts_with(words, "\n").to_numpy(zero_copy_only=False)
        spaced, behind = words.filter(pa.array(~line)), pc.utf8_slice_codeunits(words.filter(pa.array(line)), 1)
        first = dict(zip(distinct := list(dict.fromkeys(heads)), self.first.many(distinct)))
        values = self.spaced.marked(spaced)
        values += [None if ids is None else self.newline + ids for ids in self.first.marked(behind)]
        values += map(first.__getitem__, heads)
        codes = np.where(line, len(spaced) + np.cumsum(line) - 1, np.cumsum(~line) - 1)[codes]
        codes[begins[:-1]] = len(words) + np.arange(len(texts))

        ids = pa.array(values, pa.large_binary())
        unknown = ids.is_null().to_numpy(zero_copy_only=False)[codes]
        if pc.any(pc.equal(behind, "")).as_py():  # of two line breaks between words each is a token
            alone = len(spaced) + pc.index(behind, "").as_py()
            begins_line = (codes >= len(spaced)) & (codes < len(words))
            unknown[1:-1] &= ~((codes[1:-1] == alone) & begins_line[2:] & ~unknown[2:] & ~unknown[:-2])
            values[alone] = self.newline
            ids = pa.array(values, pa.large_binary())
        again = np.add.reduceat(unknown, begins[:-1], dtype=np.int64) > 0
        for added in self.added:
            again |= pc.match_substring(texts, added).to_numpy(zero_copy_only=False)
        joined = pc.fill_null(ids, b"").take(pa.array(codes))  # one buffer of the ids of all texts
        ends, held = np.frombuffer(joined.buffers()[1], np.int64, len(codes) + 1)[begins].tolist(), memoryview(joined.buffers()[2] or b"")
        for row, (begin, end) in enumerate(zip(ends[:-1], ends[1:])):
            yield self(texts[row].as_py()) if again[row] else bytes(held[begin:end])

    def __call__(self, text: str | None) -> bytes:
        """The ids as little-endian bytes of ``dtype``; null and empty texts have none."""
        if not text:
            return b""
        head, *parts = text.split(" ")
        try:
            return b"".join([self.first[head], *map(self.spaced.__getitem__, parts)])
        except TypeError:  # a part is None
            head, *parts = INNER_SPACE.split(text)
            found = [self.library(head)]
            for part in parts:
                ids = self.spaced[part]
                found.append(self.library(" " + part) if ids is None else ids)
            return b"".join(found)


def encoder(path: str) -> ByteLevelEncoder:
    return worker_state("encoder " + path, lambda: ByteLevelEncoder(path))


def ids_crc32(payload: bytes, dtype: np.dtype) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.frombuffer(payload, dtype).astype("<u4").tobytes())


def crc32_of(column: str, dtype: str) -> Column:
    @F.arrow_udf("long")
    def digest(payloads: pa.Array) -> pa.Array:
        return pa.array([ids_crc32(x, np.dtype(dtype)) for x in payloads.to_pylist()], pa.int64())

    return digest(F.col(column))


def vocabulary_dtype(path: str) -> str:
    """Type of stored ids: two bytes where the vocabulary allows it, else four."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"

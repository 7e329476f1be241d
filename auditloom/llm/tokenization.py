"""Exact, memoised encoding with a public byte-level BPE of the tokenizers library.

A byte-level pre-tokenizer always starts a new pre-token at a blank that a character other than white space follows:
a blank belongs to a pre-token only at its start, and of a longer run of white space the last blank goes with the next word.
Texts are therefore cut before such blanks, and each distinct piece is encoded by the library once per worker.
A text that holds the string of an added token, which the library matches before it pre-tokenizes, is encoded whole.
"""

from __future__ import annotations

import os
import re
import string
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Entries of a worker's memo of one kind; a full one starts anew with the strings of its last call. Bounds memory, never the result.
MEMO_ENTRIES = 500_000
#: Strings longer than this are encoded each time.
MEMO_CHARS = 24

#: Blank and newline in the byte alphabet, and how many words go to the model at a time.
BLANK, NEWLINE = "Ġ", "Ċ"
JOINED = 200
#: A blank before white space or the end, for Arrow; it takes in all white space of the library's rule.
BLANK_BEFORE_SPACE = r" (?:[\s\x0b\x1c-\x1f\x{85}\pZ]|\z)"
#: Signs after the letters of a word; they are a pre-token of their own.
SIGNS = string.punctuation

_UNSAFE_BLANK = re.compile(r" (?=\s|\Z)")


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of the public byte-level alphabet: printable Latin-1 stands for itself, the rest follow from U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def pieces_of(text: str) -> list[str]:
    """Cut before every blank that something other than white space follows; the pieces joined are the text."""
    parts = text.split(" ")
    if not _UNSAFE_BLANK.search(text):
        return parts[:1] + [" " + p for p in parts[1:]]
    out = parts[:1]
    for p in parts[1:]:
        if p and not p[0].isspace():
            out.append(" " + p)
        else:
            out[-1] += " " + p
    return out


class Memo:
    """The ids of strings, kept as Arrow columns: known ones are found by one hash join, only new ones reach the library."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]]):
        self.encode = encode
        self.keys, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def get(self, strings: pa.Array) -> pa.Array:
        coded = strings.dictionary_encode()
        distinct = coded.dictionary
        at = pc.index_in(distinct, value_set=self.keys)
        new = pc.is_null(at)
        fresh = distinct.filter(new)
        ids = pa.concat_arrays([self.ids, pa.array(self.encode(fresh.to_pylist()), pa.large_binary())])
        place = pc.fill_null(at, 0).to_numpy().astype(np.int64)
        place[new.to_numpy(zero_copy_only=False)] = len(self.keys) + np.arange(len(fresh))
        found = ids.take(pa.array(place))
        full = len(self.keys) + len(fresh) > MEMO_ENTRIES
        short = pc.less_equal(pc.utf8_length(distinct if full else fresh), MEMO_CHARS)
        if full:
            self.keys, self.ids = distinct.filter(short), found.filter(short)
        else:
            self.keys = pa.concat_arrays([self.keys, fresh.filter(short)])
            self.ids = pa.concat_arrays([self.ids, ids.slice(len(ids) - len(fresh)).filter(short)])
        return found.take(coded.indices)


def _back(second: np.ndarray) -> np.ndarray:
    """Where each row stands once those of the second kind are put behind the others."""
    out = np.empty(len(second), np.int64)
    out[np.argsort(second, kind="stable")] = np.arange(len(second))
    return out


class Encoder:
    """encode(texts) equals encode_batch(texts, add_special_tokens=False) with truncation and padding off."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values() if t.content]
        size = self.tok.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        alphabet = byte_alphabet()
        self.token_bytes = [b""] * size
        for token, i in self.tok.get_vocab(with_added_tokens=True).items():
            self.token_bytes[i] = token.encode() if token in self.added else bytes(alphabet[c] for c in token)
        self.decimal = [str(i).encode() for i in range(size)]
        self.letters = {b: c for c, b in alphabet.items()}
        self.bare = Tokenizer(self.tok.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.begins = np.zeros(size, bool)
        self.begins[[i for token, i in self.tok.get_vocab(with_added_tokens=False).items() if token[0] in (BLANK, NEWLINE)]] = True
        self.after_blank = Memo(lambda words: self._letters(words, BLANK))
        self.after_newline = Memo(lambda words: self._letters(words, NEWLINE + " "))
        self.signs = Memo(self._plain)
        self.other = Memo(lambda words: self._plain([" " + w for w in words]))

    def _split(self, ids: np.ndarray, starts: np.ndarray) -> list[bytes]:
        raw, at = ids.tobytes(), (starts * self.dtype.itemsize).tolist()
        return [raw[a:b] for a, b in zip(at, [*at[1:], len(raw)])]

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), self.dtype)
        return self._split(ids, np.cumsum([0, *map(len, found)])[:-1])

    def _letters(self, words: list[str], before: str) -> list[bytes]:
        """The ids of words of letters after a blank, with which they are one pre-token, or after a newline, which is its own.
        They go to the library's model many at a time, in its byte alphabet; a token that begins so begins the next word."""
        mapped = [before + (w if w.isascii() else w.encode().decode("latin-1").translate(self.letters)) for w in words]
        joined = [" ".join(mapped[a : a + JOINED]) for a in range(0, len(mapped), JOINED)]
        found = [e.ids for e in self.bare.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), self.dtype)
        return self._split(ids, np.flatnonzero(self.begins[ids]))

    def words(self, distinct: pa.Array) -> pa.Array:
        """The ids of a blank and each word. Words of letters, then signs, once or again after single newlines are put
        together from the ids of these parts, each of which is a pre-token."""
        lists = pc.split_pattern(distinct, "\n")
        lines, cuts = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        letters = pc.utf8_rtrim(lines, characters=SIGNS)
        simple = np.logical_and.reduceat(pc.utf8_is_alpha(letters).to_numpy(zero_copy_only=False), cuts[:-1]) if len(distinct) else np.zeros(0, bool)
        count = np.diff(cuts)
        picked = np.repeat(simple, count)
        later = np.ones(len(lines), bool)
        later[cuts[:-1]] = False
        later = later[picked]
        lines, letters = lines.filter(pa.array(picked)), letters.filter(pa.array(picked))
        # Letters and signs in turn, by offsets into the same bytes.
        at = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
        both = np.append(np.stack([at[:-1], at[:-1] + pc.binary_length(letters).to_numpy()], axis=1).ravel(), at[-1:])
        turns = pa.Array.from_buffers(pa.large_string(), 2 * len(lines), [None, pa.py_buffer(both), lines.buffers()[2]])
        found = pa.concat_arrays([self.after_blank.get(letters.filter(pa.array(~later))), self.after_newline.get(letters.filter(pa.array(later)))])
        found = found.take(pa.array(_back(later)))
        found = pc.binary_join_element_wise(found, self.signs.get(turns.take(pa.array(np.arange(1, 2 * len(lines), 2)))), pa.scalar(b"", pa.large_binary()))
        # Lines of a word stand together, so its ids are theirs in a row.
        at = np.frombuffer(found.buffers()[1], np.int64)[found.offset : found.offset + len(found) + 1]
        whole = at[np.concatenate([[0], np.cumsum(count[simple])])]
        out = pa.Array.from_buffers(pa.large_binary(), int(simple.sum()), [None, pa.py_buffer(whole), found.buffers()[2]])
        return pa.concat_arrays([out, self.other.get(distinct.filter(pa.array(~simple)))]).take(pa.array(_back(~simple)))

    def column(self, text: pa.Array) -> tuple[memoryview, np.ndarray]:
        """All texts' ids as one run of little-endian bytes of self.dtype, and where each text's begin in it (null: empty).

        Arrow cuts the texts at blanks, finds the distinct words and lays out their ids. Words are looked up by their letters,
        signs and line ends, which recur more often."""
        text = pc.fill_null(text.cast(pa.large_string()), "")
        whole = pc.match_substring_regex(text, BLANK_BEFORE_SPACE)
        for a in self.added:
            whole = pc.or_(whole, pc.match_substring(text, a))
        slow = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        lists = pc.split_pattern(pc.if_else(whole, "", text), " ")
        parts = lists.flatten()
        first = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
        coded = parts.dictionary_encode()
        place = coded.indices.to_numpy().astype(np.int64)
        later = np.ones(len(place), bool)
        later[first] = False
        inner = np.zeros(len(coded.dictionary), bool)
        inner[place[later]] = True  # parts that only ever begin a text have no blank before them
        used = np.flatnonzero(inner)
        rank = np.zeros(len(coded.dictionary), np.int64)
        rank[used] = np.arange(len(used))
        place = rank[place]
        begins = pc.take(parts, pa.array(first)).to_pylist()
        for i in slow.tolist():
            begins[i] = text[i].as_py()
        heads = pa.array(self._heads(begins, set(slow.tolist())), pa.large_binary())
        place[first] = len(used) + np.arange(len(first))
        words = coded.dictionary.take(pa.array(used))
        values = pa.concat_arrays([self.words(words), heads])
        laid = values.take(pa.array(place))
        at = np.frombuffer(laid.buffers()[1], np.int64)[laid.offset : laid.offset + len(laid) + 1]
        return memoryview(laid.buffers()[2] or b""), at[np.append(first, len(place))]

    def _heads(self, begins: list[str], slow: set[int]) -> list[bytes]:
        """The first piece of each text, or the whole text where it may not be cut at every blank."""
        cut = [([b] if any(a in b for a in self.added) else pieces_of(b)) if i in slow else [b] for i, b in enumerate(begins)]
        distinct = list({p for ps in cut for p in ps})
        found = dict(zip(distinct, self._plain(distinct)))  # too few to be met again
        return [b"".join(map(found.__getitem__, ps)) for ps in cut]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian bytes of self.dtype."""
        data, at = self.column(pa.array(texts, pa.string()))
        return [bytes(data[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]

    def decode(self, ids: list[int]) -> str:
        """decode(ids, skip_special_tokens=False): the tokens' bytes as UTF-8, bytes that are not become U+FFFD."""
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker and path."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")

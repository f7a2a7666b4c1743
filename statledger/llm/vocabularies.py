"""Token ids of whole texts under a public tokenizer file.

A vocabulary that drops white space and marks the end of each word gives a word the same ids wherever it stands, so each
distinct word is tokenised once per Python worker and its ids are copied to its places.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from statledger.llm.textarrays import Words, utf8

# Fixed value: the splitting rule for which a run of letters followed by marks is two pieces.
LETTERS_THEN_MARKS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
MARKS = ".,;:!?)\"*$%&#|"
#: Words, and pieces of words, kept by a worker; beyond, it starts anew.
MEMO_WORDS = 1_500_000
_PER_CALL = 2_000


class Memo:
    """Ids of strings met before, as Arrow arrays (a tenth of the memory of a dict), found by sorted 64-bit hashes.

    What a lookup costs depends on the strings looked up, not on those that are held.
    """

    def __init__(self):
        self.keys, self.ids = pa.array([], pa.string()), pa.array([], pa.large_binary())
        self.hashes, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def find(self, strings: pa.Array) -> pa.Array:
        """Position of each string, null if it is new (or another string has its hash)."""
        if not len(self.keys) or not len(strings):
            return pa.nulls(len(strings), pa.int32())
        own = _hashes(strings)
        order = np.argsort(own)  # searched in order, which spares the processor's cache
        at = np.empty(len(own), np.int64)
        at[order] = np.minimum(np.searchsorted(self.hashes, own[order]), len(self.hashes) - 1)
        places = pa.array(self.places[at], mask=self.hashes[at] != own)
        same = pc.fill_null(pc.equal(self.keys.take(places), strings), False)
        return pc.if_else(same, places, pa.scalar(None, pa.int32()))

    def add(self, keys: pa.Array, ids: pa.Array) -> None:
        own = _hashes(keys)
        order = np.argsort(own)
        at = np.searchsorted(self.hashes, own[order])
        self.hashes = np.insert(self.hashes, at, own[order])
        self.places = np.insert(self.places, at, (len(self.keys) + order).astype(np.int32))
        self.keys, self.ids = pa.concat_arrays([self.keys, keys]), pa.concat_arrays([self.ids, ids])

    def take(self, strings: pa.Array, learn: Callable[[pa.Array], tuple[pa.Array, pa.Array]]) -> pa.Array:
        """Ids of distinct strings; ``learn`` gives strings and ids of those that are new, in any order."""
        at = self.find(strings)
        if at.null_count:
            self.add(*learn(strings.filter(pc.is_null(at))))
            at = self.find(strings)
        found = self.ids.take(at)
        if at.null_count:
            # Different strings of one hash: all but the first one met are learned each time.
            new = pc.is_null(at)
            keys, ids = learn(strings.filter(new))
            found = pc.coalesce(found, ids.take(pc.index_in(strings, value_set=keys)))
        return found


def _hashes(strings: pa.Array) -> np.ndarray:
    data, offsets = utf8(strings)
    data = np.append(data, np.uint8(0))  # an empty string may be the last
    return Words(data, offsets[:-1], offsets[1:], offsets).hashes


class Vocabulary:
    """Encodes columns of texts under the tokenizers file at ``path``; ``dtype`` is that of the ids."""

    dtype = np.uint32

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        suffix = rules["model"].get("end_of_word_suffix")
        steps = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [rules.get("pre_tokenizer") or {}]
        drops = any(s.get("type") == "Split" and s.get("behavior") == "Removed" for s in steps)
        self.by_word = bool(suffix) and drops
        self.by_piece = self.by_word and any(s.get("pattern", {}).get("Regex") == LETTERS_THEN_MARKS for s in steps)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        if suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        # Of a vocabulary over bytes: one byte of a character that has several.
        single = [i for token, i in vocabulary.items() if len(t := token.removesuffix(suffix or "")) == 1 and ord(t) > 0x7F]
        self.is_byte = np.zeros(len(self.ends), dtype=bool)
        self.is_byte[single] = True
        self.words, self.pieces = Memo(), Memo()

    def _raw(self, texts: list[str]) -> list[bytes]:
        return [
            np.asarray(x.ids, dtype=self.dtype).tobytes()
            for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ]

    def _of_pieces(self, pieces: pa.Array) -> pa.Array:
        """Ids of runs of letters, tokenised many at a time: each ends at the only token that ends a word."""
        found = []
        for i in range(0, len(pieces), _PER_CALL):
            some = pieces[i : i + _PER_CALL].to_pylist()
            ids = np.asarray(
                self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype=self.dtype
            )
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(some) or ends[-1] != len(ids):
                found.append(pa.array(self._raw(some), pa.large_binary()))
                continue
            offsets = np.concatenate([[0], ends]) * ids.itemsize
            found.append(
                pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(some), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids)]
                )
            )
        return pa.concat_arrays(found) if found else pa.array([], pa.large_binary())

    def _learn(self, new: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Words and their ids, in another order."""
        if not self.by_piece:
            return new, pa.array(self._raw(new.to_pylist()), pa.large_binary())
        letters = pc.utf8_rtrim(new, MARKS)
        plain = pc.utf8_is_alpha(letters)
        whole, new = new.filter(pc.invert(plain)), new.filter(plain)
        letters = letters.filter(plain)
        letters = pc.if_else(pc.string_is_ascii(letters), pc.ascii_lower(letters), letters)
        distinct = letters.dictionary_encode()
        taken = self.pieces.take(distinct.dictionary, lambda unknown: (unknown, self._of_pieces(unknown))).take(distinct.indices)
        tails = _tails(new, letters)
        kinds = tails.dictionary_encode()
        codes = pa.array(self._raw(kinds.dictionary.to_pylist()), pa.large_binary())
        tails = codes.take(kinds.indices)
        ids = pc.binary_join_element_wise(taken, tails, pa.scalar(b"", pa.large_binary()))
        return pa.concat_arrays([new, whole]), pa.concat_arrays([ids, pa.array(self._raw(whole.to_pylist()), pa.large_binary())])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts together, and the offset at which each text's begin (and the last's end); null is empty."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column.cast(pa.string()), "")
        size = np.dtype(self.dtype).itemsize
        if not self.by_word or not len(column):
            texts = self._raw(column.to_pylist())
            sizes = np.array([len(x) for x in texts], dtype=np.int64) // size
            return np.frombuffer(b"".join(texts), dtype=self.dtype), np.concatenate([[0], np.cumsum(sizes)])
        split = pc.ascii_split_whitespace(column)
        coded = split.flatten().dictionary_encode()
        if len(self.words.keys) > MEMO_WORDS:
            self.words, self.pieces = Memo(), Memo()
        ids = self.words.take(coded.dictionary, self._learn).take(coded.indices)
        _, offsets, data = ids.buffers()
        ends = np.frombuffer(offsets, dtype=np.int64)[ids.offset :][: len(ids) + 1] // size
        flat = np.frombuffer(data, dtype=self.dtype)[: ends[-1]] if data is not None and ends[-1] else np.zeros(0, self.dtype)
        first = split.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        return flat, ends[first - first[0]]


def _tails(words: pa.Array, heads: pa.Array) -> pa.Array:
    """What follows each word's head; a head is as long as the word's own beginning."""
    _, offsets, data = words.cast(pa.large_string()).buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[words.offset :][: len(words) + 1]
    skip = starts[:-1] + pc.binary_length(heads).to_numpy(zero_copy_only=False)
    sizes = starts[1:] - skip
    out = np.concatenate([[0], np.cumsum(sizes)])
    places = np.repeat(skip - out[:-1], sizes) + np.arange(out[-1])
    raw = np.frombuffer(data, dtype=np.uint8)[places] if len(places) else np.zeros(0, np.uint8)
    return pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(out.astype(np.int64)), pa.py_buffer(raw))


class SentencePieces(Vocabulary):
    """The same for a sentencepiece model: each word is encoded by itself, as at the beginning of a text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.by_word, self.by_piece = True, False
        self.is_byte = np.array([self.model.is_byte(i) for i in range(len(self.model))])
        self.words, self.pieces = Memo(), Memo()

    def _raw(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(x, dtype=self.dtype).tobytes() for x in self.model.encode(texts, num_threads=1)]


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary at ``path``, loaded once per process."""
    if path not in _loaded:
        _loaded[path] = (SentencePieces if path.endswith(".model") else Vocabulary)(path)
    return _loaded[path]


def public_path(name: str) -> str:
    """Place of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)

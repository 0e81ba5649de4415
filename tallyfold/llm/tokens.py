"""Token ids of whole texts by the tokenizers library, encoding each distinct piece once.

Both vocabularies never merge across certain places of a text: before a single space
that follows something else, and between plain letters and plain punctuation. Texts are
cut at these places, column by column in Arrow, which also finds the distinct pieces of some
megabytes of text and the words in them; a worker keeps the ids of the words it has met. Pieces
with anything unusual in them are left uncut, so the ids are always those of the library
for the whole text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallyfold.llm.worker import held

# Letters that every version of Unicode takes for letters.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_EVERY_LETTER = "".join(filter(re.compile(f"[{_LETTERS}]").match, map(chr, range(256))))
# Punctuation that is neither part of a contraction nor of a special token.
_MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
# A word, and the marks that end it.
_WORD = rf"^[{_LETTERS}]+[{re.escape(_MARKS)}]*$"
# A piece that may be cut around each run of plain letters, and each of its parts is then
# what the vocabulary's own rules would cut off: a word of its model.
_SIMPLE = re.compile(rf" ?[{_LETTERS}]+(?:(?:[.,]\n?|\n)[{_LETTERS}]+)*[.,]?\n?")
_PARTS = re.compile(rf" ?[{_LETTERS}]+|[.,\n]")
# White space, as Python has it, before a space: such a space does not begin a piece.
_WIDE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "
_AFTER_TEXT = re.compile(r"(?<=\S) ")
# Words, and other pieces, that a worker keeps; beyond that, new ones are encoded anew each time.
KEPT_WORDS, KEPT_PIECES = 150_000, 50_000
# Longer ones are never kept, so the worker's tables are bounded in bytes as well.
LONGEST_KEPT = 64
# Bytes of text that are encoded at a time, unless one text is longer.
PART_BYTES = 2 * 2**20


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if it can be seen,
    else the next one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Encodes texts to little-endian ids of type `dtype`; `lowering` for the word vocabulary."""

    def __init__(self, path: str, dtype: str = "<u4"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self.dtype = dtype
        # A vocabulary that treats all white space alike drops it, and ignores case.
        self._spaceless = self._encode(["a \n b"])[0] == self._encode(["A b"])[0]
        self._model, self._letters = self._tokenizer.model, _byte_letters()
        # By word, without the space before it, and by any other piece as it stands.
        self._words: dict[str, bytes] = {}
        self._pieces: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def _looked_up(self, known: dict[str, bytes], limit: int, keys: list[str], ids) -> list[bytes]:
        """Ids of distinct keys: those that are known, and of the others as `ids` has them."""
        found = list(map(known.get, keys))
        new = [i for i, value in enumerate(found) if value is None]
        for i, value in zip(new, ids([keys[i] for i in new])):
            found[i] = value
            if len(known) < limit and len(keys[i]) <= LONGEST_KEPT:
                known[keys[i]] = value
        return found

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words of the model, which needs none of the tokenizer's other steps."""
        tokenize, letters, width = self._model.tokenize, self._letters, np.dtype(self.dtype).itemsize
        ids, ends = [], [0]
        for word in words:
            ids += [t.id for t in tokenize(word.encode().decode("latin-1").translate(letters))]
            ends.append(len(ids) * width)
        whole = np.array(ids, self.dtype).tobytes()
        return [whole[a:b] for a, b in zip(ends, ends[1:])]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words; a vocabulary with spaces has one before each."""
        before = "" if self._spaceless else " "
        return self._looked_up(self._words, KEPT_WORDS, words, lambda new: self._encode_words([before + w for w in new]))

    def _part_ids(self, pieces: list[str]) -> list[bytes]:
        simple = [_SIMPLE.fullmatch(piece) is not None for piece in pieces]
        odd = iter(self._encode([p for p, plain in zip(pieces, simple) if not plain]))
        if self._spaceless:
            cut = [[w for w in _PARTS.findall(p.lower()) if w != "\n"] if plain else None for p, plain in zip(pieces, simple)]
        else:
            cut = [_PARTS.findall(p) if plain else None for p, plain in zip(pieces, simple)]
        parts = set().union(*[c for c in cut if c])
        if self._spaceless:
            inner, outer = [*parts], []
        else:
            inner, outer = [p[1:] for p in parts if p[0] == " "], [p for p in parts if p[0] != " "]
        known = dict(zip(inner if self._spaceless else [" " + w for w in inner], self._word_ids(inner)))
        known |= zip(outer, self._looked_up(self._pieces, KEPT_PIECES, outer, self._encode_words))
        fetch = known.__getitem__
        return [next(odd) if parts is None else b"".join(map(fetch, parts)) for parts in cut]

    def _piece_ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces of any kind, as they stand."""
        return self._looked_up(self._pieces, KEPT_PIECES, pieces, self._part_ids)

    def _distinct_ids(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pieces, each without the space before it: words and marks apart, others as a whole."""
        plain = pc.match_substring_regex(pieces, _WORD)
        simple, others = pieces.filter(plain), _strings(pieces.filter(pc.invert(plain)))
        words = pc.utf8_rtrim(simple, _MARKS)
        words = (pc.utf8_lower(words) if self._spaceless else words).dictionary_encode()
        marks = pc.utf8_ltrim(simple, _EVERY_LETTER).dictionary_encode()
        ids = pc.binary_join_element_wise(
            pa.array(self._word_ids(_strings(words.dictionary)), pa.large_binary()).take(words.indices),
            pa.array(self._piece_ids(_strings(marks.dictionary)), pa.large_binary()).take(marks.indices),
            pa.scalar(b"", pa.large_binary()))
        rest = pa.array(self._piece_ids(others if self._spaceless else [" " + p for p in others]), pa.large_binary())
        # Places in the one or the other, in the order of the pieces.
        mask = plain.to_numpy(zero_copy_only=False)
        places = np.where(mask, np.cumsum(mask) - 1, len(ids) + np.cumsum(~mask) - 1)
        return pa.concat_arrays([ids, rest]).take(pa.array(places))

    def _wide_ids(self, texts: list[str]) -> list[bytes]:
        """Ids of texts with more white space than single spaces."""
        cut = []
        for text in texts:
            first, *others = _AFTER_TEXT.split(text)
            # The space belongs to the piece it begins.
            cut.append([first, *[" " + piece for piece in others]])
        pieces = set().union(*cut)
        spaced, others = [p for p in pieces if p[:1] == " "], [p for p in pieces if p[:1] != " "]
        known = dict(zip(others, self._piece_ids(others)))
        known |= zip(spaced, self._distinct_ids(pa.array([p[1:] for p in spaced], pa.string())).to_numpy(zero_copy_only=False))
        fetch = known.__getitem__
        return [b"".join(map(fetch, pieces)) for pieces in cut]

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Ids of each text as bytes, a null text as an empty one."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        if not len(texts):
            return []
        texts = pc.fill_null(texts, "")
        if self._spaceless:
            wide = None
            cut = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        else:
            wide = pc.match_substring_regex(texts, _WIDE)
            cut = pc.split_pattern(pc.if_else(wide, pa.scalar("", texts.type), texts), " ")
        edges, pieces = cut.offsets.to_numpy(), cut.values.dictionary_encode()
        distinct, places = self._distinct_ids(pieces.dictionary), pieces.indices.to_numpy()
        if not self._spaceless:
            # No space comes before the first piece of a text.
            firsts = cut.values.take(pa.array(edges[:-1])).dictionary_encode()
            first_ids = pa.array(self._piece_ids(_strings(firsts.dictionary)), pa.large_binary())
            places = places.copy()
            places[edges[:-1]] = len(distinct) + firsts.indices.to_numpy()
            distinct = pa.concat_arrays([distinct, first_ids])
        whole = distinct.take(pa.array(places))
        _, ends, data = whole.buffers()
        ends = np.frombuffer(ends, np.int64)[edges].tolist()
        data = memoryview(data or b"")
        found = [bytes(data[a:b]) for a, b in zip(ends, ends[1:])]
        if wide is not None and pc.any(wide).as_py():
            at = np.flatnonzero(wide.to_numpy(zero_copy_only=False)).tolist()
            for i, ids in zip(at, self._wide_ids(_strings(texts.filter(wide)))):
                found[i] = ids
        return found

    def encode_parts(self, texts: pa.Array) -> Iterator[list[bytes]]:
        """The ids of a column in order, some megabytes of text at a time."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
        at, done = 0, 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(ends, done + PART_BYTES, "right")))
            yield self.encode(texts.slice(at, stop - at))
            at, done = stop, int(ends[stop - 1])


def _strings(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()


def encoder(path: str, dtype: str = "<u4") -> Encoder:
    """The worker's encoder for a vocabulary; it outlives the task, with what it has met, until the worker does other work."""
    return held((path, dtype), lambda: Encoder(path, dtype))

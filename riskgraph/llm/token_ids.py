"""Token ids of whole texts, as little-endian unsigned 32-bit integers."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from riskgraph.llm.memory import as_task

# Distinct pieces whose ids a worker remembers before it starts afresh, about 200 bytes each.
CACHE_PIECES = 500_000
# Characters of text that are split into pieces at a time, apart from a longer single text.
PART_CHARS = 8 << 20
# Letters of the Latin blocks that stay one letter in lower case, and marks after them.
SIMPLE = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([.,;:!?]*)")


def _byte_letters() -> dict[int, int]:
    """The letters that byte-level vocabularies write for bytes that do not print."""
    printing = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - printing))}


class _Pieces(dict):
    """Ids of pieces of text, each with ``lead`` before it, remembered while there are few.

    A word of common letters goes to the model as it is, marks after it on their own; any other
    piece takes the whole tokenizer. None stands for a piece whose tokens depend on its neighbours.
    """

    def __init__(self, coder: TokenCoder, lead: str) -> None:
        super().__init__()
        self.coder, self.lead = coder, lead

    def __missing__(self, piece: str) -> bytes | None:
        if found := SIMPLE.fullmatch(piece):
            word, marks = found.groups()
            ids = (self[word] + self.coder.bare[marks] if marks else
                   self.coder.word(self.lead + word))
        else:
            ids = self.coder.odd_piece(self, piece)
        if len(piece) < 64:
            self[piece] = ids
        return ids

    def tidy(self, most: int) -> None:
        if len(self) > most:
            self.clear()


class TokenCoder:
    """Ids of whole texts, put together from the ids of the pieces between single spaces.

    Vocabularies that drop white space have no token across it. Byte-level ones begin a token at
    a space between two other characters, so each piece is taken with the space before it; a
    text with more white space around a space goes to the tokenizer as a whole.
    """

    def __init__(self, path: str, cache: int = CACHE_PIECES) -> None:
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.drops_space = self.tokenizer.normalizer is not None
        self.letters = _byte_letters()
        self.space = chr(self.letters[ord(" ")])
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.bare = _Pieces(self, "")
        self.spaced = self.bare if self.drops_space else _Pieces(self, " ")
        self.line_feed = self.whole("\n")
        self.cache = cache

    def whole(self, text: str) -> bytes:
        packed = self.packed
        return b"".join([packed[i] for i in
                         self.tokenizer.encode(text, add_special_tokens=False).ids])

    def word(self, word: str) -> bytes:
        """Ids of one plain word, with a space before it or not."""
        if self.drops_space:
            word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        elif word[0] == " ":
            word = self.space + word[1:]
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(word)])

    def odd_piece(self, pieces: _Pieces, piece: str) -> bytes | None:
        if not self.drops_space:
            if not piece:
                return None if pieces.lead else b""
            if piece[0].isspace() or piece[-1].isspace():
                return None
            if "\n" in piece:
                return self.lines(pieces, piece.split("\n"))
        return self.whole(pieces.lead + piece)

    def lines(self, pieces: _Pieces, lines: list[str]) -> bytes:
        """Ids of a piece cut at its line feeds; from the first one on that has more white space
        around it, the rest goes to the tokenizer as a whole."""
        ids = []
        for k, line in enumerate(lines[:-1]):
            after = lines[k + 1]
            if not line or not after or line[-1].isspace() or after[0].isspace():
                ids.append(self.whole(pieces.lead + "\n".join(lines[k:])))
                break
            ids += pieces[line], self.line_feed
            pieces = self.bare
        else:
            ids.append(pieces[lines[-1]])
        return b"".join(ids)

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text of an Arrow array of strings; null is empty.

        Each distinct piece of a part is looked up once, the rest is done on whole columns.
        """
        texts = pc.fill_null(texts, "")
        ends = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + PART_CHARS, "right")))
            yield from self._encode_part(texts.slice(at, stop - at))
            at = stop

    def _encode_part(self, texts: pa.Array) -> Iterator[bytes]:
        self.bare.tidy(self.cache)
        self.spaced.tidy(self.cache)
        split = pc.split_pattern(texts, " ")
        bounds = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        place = coded.indices.to_numpy()
        ids = list(map(self.spaced.__getitem__, pieces))
        if self.spaced is not self.bare:  # the first piece of a text has no space before it
            firsts = place[bounds[:-1]]
            place = place.copy()
            place[bounds[:-1]] = len(ids) + np.arange(len(firsts))
            ids += [self.bare[pieces[k]] for k in firsts]
        odd = np.fromiter((x is None for x in ids), bool, len(ids))
        whole = set()
        if odd.any():
            whole = set((np.searchsorted(bounds, np.flatnonzero(odd[place]), "right") - 1)
                        .tolist())
        taken = pa.array([x or b"" for x in ids], pa.large_binary()).take(pa.array(place))
        data = taken.buffers()[2]
        data = memoryview(data if data is not None else b"")
        offsets = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset:]
        cuts = offsets[bounds].tolist()
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            yield self.whole(texts[k].as_py()) if k in whole else bytes(data[a:b])


@lru_cache(maxsize=4)
def token_coder(path: str, cache: int = CACHE_PIECES) -> TokenCoder:
    return TokenCoder(path, cache)


def token_ids(text: str | Column, vocabulary: str, end_id: int,
              cache: int = CACHE_PIECES) -> Column:
    """Binary column: the ids of the whole text (null: empty), then ``end_id``.

    Strings of special tokens inside a text are ordinary text. Works on Arrow batches; a task
    keeps one batch and a bounded cache.
    """
    end = end_id.to_bytes(4, "little")

    @F.arrow_udf("binary")
    @as_task
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([x + end for x in token_coder(vocabulary, cache).encode(texts)],
                           pa.binary())

    return ids(F.col(text) if isinstance(text, str) else text)

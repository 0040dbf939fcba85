"""Token ids of many texts by a public tokenizer file, with a memory for what was seen.

The tokenizer drops white space, so the ids of a text are those of its words one after
the other, and each distinct word is encoded once per memory. Words of basic Latin letters,
digits and marks are cut into the tokenizer's pieces here and each piece is given to its
model; all other words go through the library whole."""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that need no normal form and fall into runs of letters, single digits and runs of marks.
#: Letters are those below U+0180 whose lower case is one letter again; an apostrophe may start a piece.
_PLAIN = re.compile("[!-&(-~À-ÖØ-öø-įı-ſ]+")
_PIECES = re.compile("[a-zß-öø-ſ]+|[0-9]|[!-/:-@\\[-`{-~]+")
#: What the short way knows how to do; another tokenizer goes through the library.
_NORMALIZER = ["NFC", "Replace", "Lowercase"]
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


class Tokens:
    """Ids of words, kept for at most ``most`` distinct words; then the memory starts anew."""

    def __init__(self, path: str, most: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.most = most
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [s["type"] for s in (spec["normalizer"] or {}).get("normalizers", [])]
        cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if (steps != _NORMALIZER or [c["type"] for c in cuts] != ["Split", "ByteLevel"]
                or cuts[0]["pattern"] != {"Regex": _PATTERN} or cuts[0]["behavior"] != "Removed"):
            raise ValueError("the tokenizer must drop white space and cut words by the known pattern")
        self.special = [a["content"] for a in spec["added_tokens"]]
        # the byte alphabet of the model's vocabulary
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.alphabet = {b: chr(b) for b in kept}
        self.alphabet |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in self.alphabet)}
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.wide = size > 1 << 16
        if self.library.decoder is not None:
            raise ValueError("the tokenizer must decode by joining tokens with spaces")
        #: every id as a number and as its token, in bytes
        self.numbers = [str(i).encode() for i in range(size)]
        self.words = [(self.library.id_to_token(i) or "").encode() for i in range(size)]
        self.forget()

    def forget(self) -> None:
        self.pieces: dict[str, bytes] = {}
        self.known: dict[str, int] = {"": 0}
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.starts = np.zeros(1 << 12, dtype=np.int64)
        self.lengths = np.zeros(1 << 12, dtype=np.int64)
        self.used = 0

    def _plain(self, word: str) -> bytes:
        """Ids of a plain word, as 32-bit numbers: a fraction of what lists would take."""
        ids = []
        for piece in _PIECES.findall(word.lower()):
            found = self.pieces.get(piece)
            if found is None:
                shown = piece if piece.isascii() else "".join(self.alphabet[b] for b in piece.encode())
                found = self.pieces[piece] = array("I", [t.id for t in self.library.model.tokenize(shown)]).tobytes()
            ids.append(found)
        return b"".join(ids)

    def _learn(self, words: list[str]) -> None:
        """Ids of words that are not yet known, by the short way or by the library."""
        short = [w if _PLAIN.fullmatch(w) and not any(s in w for s in self.special) else None for w in words]
        rest = [w for w, s in zip(words, short) if s is None]
        by_library = iter(self.library.encode_batch_fast(rest, add_special_tokens=False) if rest else ())
        ids = [self._plain(w) if s is not None else array("I", next(by_library).ids).tobytes()
               for w, s in zip(words, short)]
        counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), dtype=np.uint32)
        first, end = len(self.known), len(self.known) + len(words)
        while end > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + len(flat)] = flat
        self.starts[first:end] = self.used + np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.lengths[first:end] = counts
        self.known.update(zip(words, range(first, end)))
        self.used += len(flat)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's ids begin and the last ends.

        A null text has none."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        words = lists.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) + len(distinct) > self.most:
            self.forget()
        slots = np.fromiter((self.known.get(w, -1) for w in distinct), dtype=np.int64, count=len(distinct))
        new = np.flatnonzero(slots < 0)
        if len(new):
            slots[new] = np.arange(len(self.known), len(self.known) + len(new))
            self._learn([distinct[i] for i in new])
        at = slots[words.indices.to_numpy(zero_copy_only=False)]
        counts = self.lengths[at]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        place = np.repeat(self.starts[at] - (ends - counts), counts) + np.arange(total)
        bounds = np.concatenate([[0], ends])
        word_bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        return self.flat[place], bounds[word_bounds]


_TOKENS: dict[str, Tokens] = {}


def tokens_of(path: str) -> Tokens:
    """One memory per Python worker, so that it lasts over tasks."""
    if path not in _TOKENS:
        _TOKENS[path] = Tokens(path)
    return _TOKENS[path]


def slices(column: pa.Array, most_bytes: int = 4 << 20) -> list[tuple[int, int]]:
    """(start, length) of runs of rows with about so many bytes each, so that work on a batch
    takes bounded memory whatever Spark puts in it; a longer row stands alone."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    out, start, total = [], 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > most_bytes:
            out.append((start, i - start))
            start, total = i, 0
        total += n
    return out + [(start, len(sizes) - start)] if len(sizes) else out

"""Token ids of whole texts, one library call per distinct word.

Byte-level BPE never merges across the pieces its pre-tokenizer cuts, and that
pre-tokenizer always cuts before a lone blank or line break between two visible
characters. A text is therefore split there, every distinct piece goes through
the ``tokenizers`` library once, and the ids are put together again by index.
Other white space stays inside its piece, for the library to take apart. A text
that holds the string of a special token goes through the library whole.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER_FILE = "byte_bpe_50k.json"
#: Pieces kept per worker; beyond it only those met more than once stay, at most half as many (memory bound, no effect on the result).
CACHE_PIECES = 1_200_000
#: Texts are put together by index up to so many characters at a time; a longer text is alone.
GROUP_CHARS = 2_000_000
_MARK = "\x00"
#: The mark, and all white space but blanks and line breaks.
_ODD = _MARK + "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: A blank or line break, Latin letters, then ASCII signs other than the apostrophe: the pre-tokenizer cuts such a
#: piece into exactly these parts (the blank stays with the letters).
_SIMPLE = re.compile("(\n?)( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\\[-`{-~]*)")


def default_tokenizer() -> str:
    """Path of the public byte-level BPE file, the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER_FILE)


class Pieces(dict):
    """piece, or (None, id put after texts) -> number; a new one gets the next number and is noted."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


class Encoder:
    """Encodes texts with the file at ``path``, as the library's plain call without added ids does."""

    def __init__(self, path: str | None = None, kept: int | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path or default_tokenizer())
        self._special = [token.content for token in self._tokenizer.get_added_tokens_decoder().values()]
        self._model = self._tokenizer.model
        alphabet = [self._tokenizer.pre_tokenizer.pre_tokenize_str(chr(b))[0][0] for b in range(128)]
        self._byte_letters = {b: alphabet[b] for b in range(128)}
        for b in range(128, 256):  # the two bytes of one character; the last of them is taken
            lead, last = chr(b).encode()
            shown = self._tokenizer.pre_tokenizer.pre_tokenize_str("x" + chr(b) + "x")
            joined = "".join(part for part, _ in shown)
            self._byte_letters[lead], self._byte_letters[last] = joined[1], joined[2]
        self._blank = self._byte_letters[32]
        self._signs: dict[str, list[int]] = {}
        self._kept = kept
        self._reset()

    def _reset(self) -> None:
        self._index = Pieces()
        self._starts = np.zeros(1 << 16, np.int64)
        self._sizes = np.zeros(1 << 16, np.int64)
        self._times = np.zeros(1 << 16, np.int64)
        self._ids = np.zeros(1 << 18, np.int32)
        self._used = self._learnt = 0

    def _trim(self) -> None:
        """Forget pieces met once since the last time, and the rarest of the others beyond half of the bound."""
        times, half, least = self._times[:self._learnt], (self._kept or CACHE_PIECES) // 2, 2
        if len(times) > half:
            least = max(least, int(np.partition(times, -half)[-half]) + 1)
        kept = np.flatnonzero(times >= least)
        names = list(compress(self._index, times >= least))
        sizes, starts, ids = self._sizes[kept], self._starts[kept], self._ids
        self._reset()
        self._index.update(zip(names, range(len(names))))
        self._store(sizes, ids[np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())])

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, np.int32) for e in found]

    def _learn(self, pieces: list[str]) -> None:
        """Find the ids of new pieces, numbered in this order."""
        for at in range(0, len(pieces), 4096):
            found = self._new_ids(pieces[at:at + 4096])
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            self._store(sizes, np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum())))

    def _store(self, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Ids of the pieces numbered next."""
        n = self._learnt
        while n + len(sizes) > len(self._starts):
            self._starts, self._sizes, self._times = (
                np.concatenate([a, np.zeros_like(a)]) for a in (self._starts, self._sizes, self._times))
        while self._used + len(ids) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        self._ids[self._used:self._used + len(ids)] = ids
        self._sizes[n:n + len(sizes)] = sizes
        self._starts[n:n + len(sizes)] = self._used + np.cumsum(sizes) - sizes
        self._learnt += len(sizes)
        self._used += len(ids)

    def _new_ids(self, pieces: list[str]) -> list[list[int]]:
        """Ids of each piece: simple ones straight through the library's BPE model, the others through all of it."""
        found: list[list[int] | None] = []
        words: dict[str, list[int]] = {}
        for piece in pieces:
            if type(piece) is tuple:  # an id to put after texts
                found.append([piece[1]] if piece[1] is not None else [])
                continue
            simple = _SIMPLE.fullmatch(piece)
            if not simple:
                found.append(None)
                continue
            line, word, signs = simple.groups()
            ids = words.get(word)
            if ids is None:
                known = self._index.get(word)
                if known is None or known >= self._learnt:
                    ids = self._part(word)
                else:
                    start = self._starts[known]
                    ids = self._ids[start:start + self._sizes[known]].tolist()
                words[word] = ids
            if line:
                ids = self._common(line) + ids
            found.append(ids + self._common(signs) if signs else ids)
        rest = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(rest, self._whole([pieces[i] for i in rest]) if rest else ()):
            found[i] = ids.tolist()
        return found

    def _part(self, part: str) -> list[int]:
        """Ids of what the pre-tokenizer leaves whole."""
        if part.isascii():  # in the model's alphabet, visible ASCII stands for itself
            shown = part.replace(" ", self._blank)
        else:
            shown = part.encode().decode("latin-1").translate(self._byte_letters)
        return [token.id for token in self._model.tokenize(shown)]

    def _common(self, part: str) -> list[int]:
        """Line breaks and signs: few and frequent, so remembered."""
        ids = self._signs.get(part)
        if ids is None:
            if len(self._signs) > 10_000:
                self._signs.clear()
            ids = self._signs[part] = [token.id for token in self._model.tokenize(part.translate(self._byte_letters))]
        return ids

    def _sort(self, text: str) -> str:
        """plain: blanks and line breaks all single and inside the text; odd: other white space; special: a special token's string."""
        if any(map(text.__contains__, self._special)):
            return "special"
        blanks = text.replace("\n", " ")
        if blanks[0] == " " or blanks[-1] == " " or "  " in blanks or any(map(blanks.__contains__, _ODD)):
            return "odd"
        return "plain"

    def encode(self, texts: list[str | None], end_id: int | None = None) -> list[np.ndarray]:
        """Ids of each text as int32, and ``end_id`` after them if there is one; a null text has none of its own."""
        out: list[np.ndarray] = []
        at = 0
        while at < len(texts):
            stop, chars = at, 0
            while stop < len(texts) and (stop == at or chars + len(texts[stop] or "") <= GROUP_CHARS):
                chars += len(texts[stop] or "")
                stop += 1
            out += self._group(texts[at:stop], end_id)
            at = stop
        return out

    def _group(self, texts: list[str | None], end_id: int | None) -> list[np.ndarray]:
        if len(self._index) > (self._kept or CACHE_PIECES):
            self._trim()
        sorts = [self._sort(t) if t else "none" for t in texts]
        plain = pa.array([t for t, sort in zip(texts, sorts) if sort == "plain"], pa.string())
        for mark in (" ", "\n"):
            plain = pc.replace_substring(plain, mark, _MARK + mark)
        cut = pc.split_pattern(plain, _MARK)
        odd = [_CUT.split(t) for t, sort in zip(texts, sorts) if sort == "odd"]
        found = pa.concat_arrays([cut.flatten(), pa.array(list(chain.from_iterable(odd)), pa.string())]).dictionary_encode()
        distinct = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(self._index.__getitem__, distinct), np.int64, len(distinct))[found.indices.to_numpy()]
        end = self._index[None, end_id]
        self._learn(self._index.new)
        self._index.new = []

        counts = {"plain": iter(np.diff(cut.offsets.to_numpy()).tolist()), "odd": map(len, odd)}
        at = {"plain": 0, "odd": len(cut.flatten())}
        order, sizes = [], []  # where each text's pieces are, texts in their own order
        for sort in sorts:
            n = next(counts[sort]) if sort in at else 0
            if n:
                order.append(numbers[at[sort]:at[sort] + n])
                at[sort] += n
            if end_id is not None:
                order.append([end])
                n += 1
            sizes.append(n)
        pieces = np.concatenate(order) if order else np.zeros(0, np.int64)
        self._times[:self._learnt] += np.bincount(numbers, minlength=self._learnt)
        lengths = self._sizes[pieces]
        ends = np.cumsum(lengths)
        ids = self._ids[np.repeat(self._starts[pieces] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]
        ends = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])]
        out = [ids[a:b] for a, b in zip(ends, ends[1:])]
        for i, sort in enumerate(sorts):
            if sort == "special":
                out[i] = np.concatenate([*self._whole([texts[i]]), out[i]])
        return out


@lru_cache(maxsize=2)
def encoder(path: str | None = None, kept: int | None = None) -> Encoder:
    """One encoder per worker process, file and bound of its pieces."""
    return Encoder(path, kept)

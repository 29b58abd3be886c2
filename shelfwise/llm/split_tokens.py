"""Token ids of a tokenizer that drops white space and never looks across it.

Such a tokenizer's ids of a text are those of its stretches between white space, so a
stretch is encoded once: Arrow splits a batch and numbers its distinct stretches, and those
met in earlier batches are remembered. A few characters that Arrow takes for white space and
the tokenizer does not, and the start of a special token, send the whole text to the library.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space of Python and Arrow that is none to the tokenizer.
NOT_SPACE = "\x1c\x1d\x1e\x1f"
WHOLE = r"[\x1c-\x1f]|<\|"
WORD_END = "</w>"
#: The tokenizer's own pieces of a stretch of ASCII without apostrophes.
PIECES = re.compile(r"[A-Za-z]+|[0-9]|[^A-Za-z0-9]+")


@functools.lru_cache(maxsize=4096)
def stays_letter(c: str) -> bool:
    """Whether a letter is letters only once normalised and lower-cased: where it is not, the
    tokenizer splits behind it, or joins what follows."""
    return unicodedata.normalize("NFC", c).lower().isalpha()


class SplitEncoder:
    """``encode(texts)`` gives each text's ids as little-endian unsigned numbers of ``kind``.

    Stretches met lately are held in two generations of at most ``most / 2``: when the young
    one is full it becomes the old one, and stretches met again move back. Longer ones than
    ``longest`` are held for their batch only.
    """

    def __init__(self, path: str, most: int = 1_200_000, longest: int = 48) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        # The same merges for words of lower-case ASCII letters, which are normalised already.
        bare = json.loads(self.library.to_str()) | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.bare = Tokenizer.from_str(json.dumps(bare))
        # ... and for words of other letters, which need no splitting but at white space.
        self.other = Tokenizer.from_str(json.dumps(bare))
        self.other.normalizer = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.other.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.library.get_vocab()
        self.size = max(vocab.values()) + 1
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.ends = np.zeros(self.size, bool)  # ids that end a word
        self.ends[[i for token, i in vocab.items() if token.endswith(WORD_END)]] = True
        self.stops = dict(zip(".,", self.whole([".", ","]), strict=True))
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        self.most, self.longest = most // 2, longest

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, words: list[str], by) -> list[bytes]:
        """Ids of words of letters only, each of which is one stretch of the tokenizer ``by`` too."""
        out: list[bytes] = []
        for i in range(0, len(words), 4096):
            part = words[i:i + 4096]
            ids = np.array(by.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, self.kind)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(part):
                out += self.whole(part)
                continue
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in itertools.pairwise([0, *(ends * self.kind.itemsize).tolist()])]
        return out

    def learn(self, new: list[str]) -> None:
        """Put distinct stretches into the young generation."""
        young, old, stops = self.young, self.old, self.stops
        plain, letters, stopped, mixed, other = set(), [], [], [], []
        for w in new:
            if (known := old.get(w)) is not None:
                young[w] = known
            elif w.isalpha():
                if w.isascii():
                    plain.add(w)
                else:
                    letters.append(w)
            elif w[-1] in stops and w[:-1].isalpha() and (w.isascii() or stays_letter(w[-2])):
                stopped.append(w)
            elif w.isascii() and "'" not in w:
                mixed.append((w, PIECES.findall(w)))
            else:
                other.append(w)
        parts = {w[:-1] for w in stopped}.union(*(p for _, p in mixed))
        for w in parts.difference(plain, letters):
            if (known := young.get(w) or old.get(w)) is not None:
                young[w] = known
            elif not w.isalpha():
                other.append(w)
            elif w.isascii():
                plain.add(w)
            else:
                letters.append(w)
        lower = {w: w.lower() for w in plain}
        distinct = list(set(lower.values()))
        coded = dict(zip(distinct, self.words(distinct, self.bare), strict=True))
        young.update((w, coded[x]) for w, x in lower.items())
        single = [all(map(stays_letter, w)) for w in letters]
        simple = [w for w, s in zip(letters, single, strict=True) if s]
        young.update(zip(simple, self.words(simple, self.other), strict=True))
        other += [w for w, s in zip(letters, single, strict=True) if not s]
        young.update(zip(other, self.whole(other), strict=True))
        young.update((w, young[w[:-1]] + stops[w[-1]]) for w in stopped)
        young.update((w, b"".join([young[p] for p in pieces])) for w, pieces in mixed)

    def looked_up(self, texts: pa.Array) -> tuple[pa.Array, list[bytes], pa.Array, np.ndarray]:
        """Which texts are sent whole; ids of the batch's distinct stretches; the texts' stretches
        by number, and where each text's begin and end among them."""
        if len(self.young) > self.most:
            self.young, self.old = {"": b""}, self.young
        odd = pc.match_substring_regex(texts, WHOLE)
        cut = pc.utf8_split_whitespace(pc.if_else(odd, "", texts))
        flat = cut.flatten().dictionary_encode()
        words, young = flat.dictionary.to_pylist(), self.young
        coded = list(map(young.get, words))
        if None in coded:
            new = [w for w, x in zip(words, coded, strict=True) if x is None]
            self.learn(new)
            coded = list(map(young.get, words))
            for w in new:
                if len(w) > self.longest:
                    del young[w]
        bounds = cut.offsets.to_numpy()
        return odd, coded, flat.indices, bounds - bounds[0]

    def encode(self, texts: pa.Array, end: int | None = None) -> pa.Array:
        """Each text's ids, and ``end`` behind them, as a binary column."""
        texts = texts.fill_null("")
        odd, coded, places, bounds = self.looked_up(texts)
        size = self.kind.itemsize
        stretches = pa.array(coded, pa.binary()).take(places)
        ids = np.frombuffer(stretches.buffers()[2] or b"", self.kind)
        at = np.frombuffer(stretches.buffers()[1], np.int32, len(stretches) + 1)[bounds].astype(np.int64) // size
        ids = ids[:at[-1]]
        if end is not None:
            last = at[1:] + np.arange(len(texts))
            out, own = np.empty(len(ids) + len(texts), self.kind), np.ones(len(ids) + len(texts), bool)
            own[last] = False
            out[own], out[last] = ids, end
            ids, at = out, at + np.arange(len(texts) + 1)
        column = pa.Array.from_buffers(pa.binary(), len(texts), [
            None, pa.py_buffer((at * size).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids))])
        if not pc.any(odd).as_py():
            return column
        tail = b"" if end is None else np.array([end], self.kind).tobytes()
        rows = column.to_pylist()
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            rows[i] = self.whole([texts[i].as_py()])[0] + tail
        return pa.array(rows, pa.binary())

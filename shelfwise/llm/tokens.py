"""Byte-level BPE through the tokenizers library, word by word with a bounded memory of words.

The pre-tokenizer of a byte-level BPE starts a new token at a single space that stands
between two characters that are no white space, and never looks back over it. So the ids
of a text are those of its stretches cut before such spaces, and a stretch met before
need not be encoded again. Texts with any other white space around a space, or with the
start of a special token, are encoded whole.
"""

from __future__ import annotations

import ctypes
import itertools
import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The byte-level sign of a space.
SPACE = "\u0120"
#: New words that the library encodes as one text: it holds about 400 bytes for each meanwhile.
AT_ONCE = 16_384


class WordEncoder:
    """``encode(texts)`` gives each text's ids as little-endian unsigned 32-bit bytes.

    Words met lately are held in two generations of at most ``most_words / 2``: when the
    young one is full it becomes the old one, and words met again move back.
    """

    def __init__(self, path: str, most_words: int = 800_000, longest: int = 48) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        # The same merges for words of ASCII letters, which are their own byte-level signs.
        bare = json.loads(self.library.to_str()) | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"},
                                                    "post_processor": None, "added_tokens": []}
        self.bare = Tokenizer.from_str(json.dumps(bare))
        vocab = self.library.get_vocab()
        self.starts = np.zeros(max(vocab.values()) + 1, bool)  # ids that start with a space
        self.starts[[i for token, i in vocab.items() if token.startswith(SPACE)]] = True
        self.tails = dict(zip(".,", self.whole([".", ","]), strict=True))
        self.young: dict[str, bytes | bool] = {}
        self.old: dict[str, bytes | bool] = {}
        self.most, self.longest = most_words // 2, longest

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def coded(self, words: list[str]) -> list[bytes]:
        """Ids of words that follow a space each: one text of all of them, cut before each space."""
        plain = [w for w in words if w.isascii() and w.isalpha()]
        known = dict(zip(plain, self.cut_up(self.bare, " ".join([SPACE + w for w in plain]), plain), strict=True))
        rest = [w for w in words if w not in known]
        known.update(zip(rest, self.cut_up(self.library, " " + " ".join(rest), rest), strict=True))
        return [known[w] for w in words]

    def cut_up(self, by, text: str, words: list[str]) -> list[bytes]:
        if not words:
            return []
        ids = np.array(by.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.starts[ids])
        if len(ends) != len(words):
            return self.whole([" " + w for w in words])
        raw, at = ids.tobytes(), [*(4 * ends).tolist(), 4 * len(ids)]
        return [raw[a:b] for a, b in itertools.pairwise(at)]

    def learn(self, new: set[str]) -> list[str]:
        """Put words into the young generation; False for those that may not be cut off.

        Returns the long ones, which are held for this batch only.
        """
        young, old = self.young, self.old
        fresh, ended = [], []
        for w in new:
            if (known := old.get(w)) is not None:
                young[w] = known
            elif not w or w[0].isspace() or w[-1].isspace() or "<|" in w:
                young[w] = False
            elif w[-1] in ".," and len(w) > 1 and w[-2].isalpha() and w[-2] < "\u0250":
                ended.append(w)  # a stop after a letter is a token of its own
            else:
                fresh.append(w)
        stems = list({w[:-1] for w in ended}.difference(fresh, young))
        fresh += [w for w in stems if w not in old]
        young.update((w, old[w]) for w in stems if w in old)
        for i in range(0, len(fresh), AT_ONCE):
            some = fresh[i:i + AT_ONCE]
            young.update(zip(some, self.coded(some), strict=True))
        for w in ended:
            stem = young[w[:-1]]
            young[w] = stem and stem + self.tails[w[-1]]
        return [w for w in [*fresh, *ended] if len(w) > self.longest]

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Arrow cuts the texts and numbers their distinct words, each of which is looked up once."""
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        young = self.young
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).fill_null("")
        cut = pc.split_pattern(texts, " ")
        flat = cut.flatten().dictionary_encode()
        words = flat.dictionary.to_pylist()
        coded = list(map(young.get, words))
        if None in coded:
            long = self.learn({w for w, x in zip(words, coded, strict=True) if x is None})
            coded = list(map(young.get, words))
            for w in long:
                young.pop(w, None)
        places, bounds = flat.indices.to_numpy(), cut.offsets.to_numpy()
        bounds = (bounds - bounds[0]).astype(np.int64)
        heads = [words[i] for i in places[bounds[:-1]].tolist()]
        # Words that may not be cut off send their text to the library whole, and so does a head
        # that does not end like a word, where words follow it.
        whole = np.concatenate([[0], np.cumsum(np.array([x is False for x in coded], bool)[places])])
        whole = whole[bounds[1:]] > whole[np.minimum(bounds[:-1] + 1, bounds[1:])]
        whole |= (np.diff(bounds) > 1) & np.array([not h or h[-1].isspace() for h in heads], bool)
        ids = pa.array([x or b"" for x in coded], pa.binary()).take(flat.indices)
        data, at = memoryview(ids.buffers()[2] or b""), np.frombuffer(ids.buffers()[1], np.int32, len(ids) + 1)
        spans = zip(at[np.minimum(bounds[:-1] + 1, bounds[1:])].tolist(), at[bounds[1:]].tolist(), strict=True)
        out = [head + bytes(data[i:j]) for head, (i, j) in zip(self.whole(heads), spans, strict=True)]
        for i in np.flatnonzero(whole).tolist():
            out[i] = self.whole([texts[i].as_py()])[0]
        return out


def give_back() -> None:
    """Memory that Arrow and (where it can) the C library hold free goes back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def gathered(batches, most: int = 12_000_000):
    """The batches' rows again, in tables of about ``most`` bytes of text (their second column),
    or of one row with more."""
    held, size = [], 0
    for b in batches:
        ends = np.cumsum(pc.binary_length(b.column(1)).fill_null(0).to_numpy())
        start = 0
        while start < b.num_rows:
            before = ends[start - 1] if start else 0
            end = max(start + (not held), int(np.searchsorted(ends, before + most - size, "right")))
            if end > start:
                held.append(b.slice(start, end - start))
                size += ends[end - 1] - before
            if end < b.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
                give_back()
            start = end
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
        held = []
    give_back()  # the worker may wait long for its next task


def by_bytes(texts: list[str | None], most: int = 2_000_000):
    """Ranges of a batch's texts that hold about ``most`` characters each."""
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t or "") > most:
            yield start, i
            start, held = i, 0
        held += len(t or "")
    if start < len(texts):
        yield start, len(texts)

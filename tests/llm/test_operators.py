"""The operators against brute-force versions on small tables with nulls, empty and long
texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from shelfwise.llm import (
    hamming_search,
    jaccard_join,
    language_id,
    license_scan,
    mixing,
    packing,
    quality,
    token_counts,
    token_files,
    tokens,
    url_filter,
)

BYTE_BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_tokens string, size string, key string"
BASE = "the quick brown fox jumps over the lazy dog and runs far away from all of its many friends today "
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
TEXTS = [
    (0, None, "en", "a"), (1, "", "en", "a"), (2, " \n\t ", None, None), (3, BASE * 2, "en", "b"),
    (4, (BASE * 2).upper(), "en", "b"), (5, BASE * 2 + "extra", "de", "a"), (6, LONG, "fr", "c"),
    (7, "Released under the MIT License. All rights reserved.", "en", None), (8, "1234 5678", "en", "c"),
    (9, "x <|endoftext|> y  z", "en", "a"), (9, "x <|endoftext|> y  z", "en", "a"), (None, "no id here", "es", "b"),
    (12, "é è. ñ, ß  日本。語 🎉", "fr", "b"),
]
OPERATORS = {
    "mix": lambda d: mixing.mix(d), "mixed": lambda d: mixing.mixed(d), "counts": lambda d: token_counts.token_counts(d, PIECES),
    "licences": lambda d: license_scan.scan(d), "classes": lambda d: jaccard_join.classes(d), "one": lambda d: jaccard_join.one_of_each(d),
    "pack": lambda d: packing.pack(d, BYTE_BPE), "files": lambda d: token_files.round_trip(d, BYTE_BPE), "quality": lambda d: quality.quality(d),
    "passed": lambda d: quality.passed(d), "identify": lambda d: language_id.identify(d), "known": lambda d: language_id.known(d),
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*t, "n", "s", "k") for t in TEXTS], SCHEMA).repartition(3)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_an_empty_table_gives_no_rows(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("name", ["mix", "counts", "licences", "classes", "files", "quality", "identify"])
def test_a_row_for_each_row(docs, name):
    got = Counter(r["doc_id"] for r in OPERATORS[name](docs).collect())
    assert got == Counter(t[0] for t in TEXTS)


def test_token_counts_split_or_not(docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = Counter((i, len((t or "").encode()), len(sp.encode(t or ""))) for i, t, _, _ in TEXTS)
    for most in (50, 1 << 20):
        got = token_counts.token_counts(docs, PIECES, split_bytes=most).collect()
        assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want


def library_ids(texts):
    from tokenizers import Tokenizer

    return [e.ids for e in Tokenizer.from_file(BYTE_BPE).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_round_trip(docs):
    got = token_files.round_trip(docs, BYTE_BPE).collect()
    rows = sorted(zip((t[0] for t in TEXTS), library_ids([t[1] for t in TEXTS])), key=lambda x: (x[0] is not None, x[0] or 0))
    want, start = Counter(), 0
    for doc_id, ids in rows:
        ids = [*ids, token_files.END]
        want[doc_id, start, len(ids), crc(ids)] += 1
        start += len(ids)
    assert Counter(map(tuple, got)) == want


def test_packing_is_gapless_and_holds_every_id(docs):
    got = packing.pack(docs, BYTE_BPE, max_len=64, bucket_rows=4).collect()
    want = Counter()
    for (doc_id, *_), ids in zip(TEXTS, library_ids([t[1] for t in TEXTS]), strict=True):
        ids = [*ids, packing.SEPARATOR]
        want.update((doc_id, k, s, n, crc(ids[s:s + n])) for k, (s, n) in enumerate(packing.cuts(len(ids), 64)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    total = sum(r["length"] for r in got)
    assert len(bins) <= -(-total // 64) + 1


def test_plan_equals_best_fit_over_single_items():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 60, 400).tolist()
    rooms: list[int] = []
    for s in sorted(sizes, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= s]
        if fits:
            rooms[min(fits)[1]] -= s
        else:
            rooms.append(60 - s)
    slots = packing.plan(dict(Counter(sizes)), 60)
    assert 1 + max(s[3] + (s[2] - s[1] - 1) // s[4] for s in slots) == len(rooms)


def test_mix_targets_balance_and_reruns(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 200))), "en", s) for i, s in enumerate(rng.choice(["a", "b", "c", None], 3000, p=[0.85, 0.05, 0.05, 0.05]).tolist())]
    df = spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA)
    got = mixing.copies(mixing.measured(df), weights=(1, 2, 3)).collect()
    size = Counter()
    for _, t, _, s in rows:
        size[s] += len(words(t))
    weight = dict(zip(["a", "b", "c", None], [1, 2, 3, 1], strict=True))
    capped: dict = {}
    while True:
        left, w = sum(size.values()) - sum(capped.values()), sum(weight[s] for s in size if s not in capped)
        more = {s: 3 * size[s] for s in size if s not in capped and left * weight[s] / w > 3 * size[s]}
        if not more:
            break
        capped |= more
    want = {s: capped.get(s, left * weight[s] / w if w else 0) for s in size}
    source = {i: s for i, _, _, s in rows}
    taken = Counter()
    for r in got:
        s = source[r["doc_id"]]
        assert abs(r["target"] - want[s]) < 1e-6 * want[s] and r["source_size"] == size[s] and 0 <= r["copies"] <= 3
        taken[s] += r["size"] * r["copies"]
    for s in want:
        assert abs(taken[s] - want[s]) <= 400
    assert sorted(map(tuple, mixing.mix(df).collect()), key=str) == sorted(map(tuple, mixing.mix(df).collect()), key=str)
    assert mixing.mixed(df).count() == sum(r["copies"] for r in got)


def test_flight_keeps_both_balances():
    rng = np.random.default_rng(1)
    size = rng.integers(1, 500, 300).tolist()
    p = [0.3] * 300
    import random

    mixing.flight(p, size, random.Random(2).random)
    assert sum(0 < x < 1 for x in p) <= 2
    assert abs(sum(p) - 90) < 1e-6 and abs(sum(x * s for x, s in zip(p, size)) - 0.3 * sum(size)) < 1e-4


def jaccard_components(rows, k, num, den):
    sets = {}
    for i, t in rows:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(t)]
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if sets[a] and sets[b] and den * common >= num * (len(sets[a]) + len(sets[b]) - common) and label[a] > label[b]:
                    label[a], changed = label[b], True
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize("most", [0, 48])
def test_jaccard_classes_against_all_pairs(spark, monkeypatch, most):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 20)
    rng = np.random.default_rng(most)
    rows = [(0, None), (1, ""), (2, "one two")]
    for group in range(6):
        start = [f"g{group}w{i}" for i in range(int(rng.integers(3, 120)))]
        for _ in range(25):
            w = list(start)
            for at in rng.integers(0, len(w), int(rng.integers(0, 1 + len(w) // 25 + 1))):
                w[at] = f"x{rng.integers(0, 40)}"
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found, names = jaccard_join.joined(df, most=most)
    label = {r["node"]: r["label"] for r in names.collect()}
    got = {r["doc_id"]: (r["n_shingles"], label.get(r["doc_id"], r["doc_id"])) for r in found.collect()}
    assert got == jaccard_components(rows, 4, 85, 100)


def test_one_of_each_keeps_columns_and_rows_without_id(docs):
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter({0: 1, 1: 1, 2: 1, 3: 1, 6: 1, 7: 1, 8: 1, 9: 1, None: 1, 12: 1})


def test_quality_statistics(docs):
    for r in quality.quality(docs).collect():
        text = next(t for i, t, _, _ in TEXTS if i == r["doc_id"])
        w = words(text)
        windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        inside = {i + j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in range(3)}
        seen, dup = set(), 0
        for line in (text or "").split("\n"):
            dup += line in seen and bool(words(line))
            seen.add(line)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(inside) > 50 * len(w))
        assert not (r["kept"] and r["base_failed"])


def test_kneser_ney_sums_to_one():
    codes, n = np.unique(np.concatenate([quality.grams(BASE * 3), quality.grams("zebra quilt")]), return_counts=True)
    m = quality.kneser_ney(codes, n)
    context = int(codes[5]) // quality.CLASSES
    total = 0.0
    for c in range(quality.CLASSES):
        g = context * quality.CLASSES + c
        at, have = quality.found(m["code3"], np.array([g]))
        if have[0]:
            total += np.exp(m["p3"][at[0]])
            continue
        at, _ = quality.found(m["context3"], np.array([context]))
        back = m["w3"][at[0]]
        at, have = quality.found(m["code2"], np.array([g % quality.CLASSES ** 2]))
        at2, known = quality.found(m["context2"], np.array([context % quality.CLASSES]))
        total += np.exp(back + (m["p2"][at[0]] if have[0] else (m["w2"][at2[0]] if known[0] else 0) + m["p1"][c]))
    assert abs(total - 1) < 1e-3


def test_language_accuracy_on_held_out(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify(df).join(df.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got) > 0
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)


def test_texts_without_letters_are_und(docs):
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs).collect()}
    assert [got[i] for i in (0, 1, 2, 8)] == ["und"] * 4


def test_licences(docs):
    got = {r["doc_id"]: (r["licenses"], r["n_unmatched"]) for r in license_scan.scan(docs).collect()}
    assert got[7] == ("MIT,Proprietary", 0) and got[3] == ("", 0)
    assert all(re.search(license_scan.MARKS, s) for s in license_scan.SENTENCES.values())


def test_url_rules(spark):
    urls = ["http://org/x", "http://a.example.org/es/1", "https://EXAMPLE.org/en/12?x", "http://example.org/en/2", "http://x.com/de/a",
            "http://notorg/", "http://a.org", "http://spam-farm.example.net/en/1", None, "no scheme", "http://b.com/fr/#z", "ftp://c.COM/fr"]
    df = spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)] * 2, "page_id long, url string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(df).collect()}
    assert [got[i][2:] for i in range(len(urls))] == [
        ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("org/", "allow"), ("com/de/", "block"),
        (None, "allow"), (None, "allow"), (None, "block"), (None, "allow"), (None, "allow"), ("com/fr/", "allow"), (None, "allow")]
    assert got[2][:2] == ("example.org", "/en/12") and got[8][:2] == ("", "")
    assert url_filter.judge(df.limit(0)).count() == 0 and url_filter.judge(df).count() == 2 * len(urls)


def test_hamming_search_against_all_pairs(spark):
    rng = np.random.default_rng(9)
    codes = rng.integers(-2 ** 62, 2 ** 62, 60).tolist() + [5] * 15
    df = spark.createDataFrame([*enumerate(codes), (None, 1), (99, None)], "id long, code long")
    got = {(r[0], r[1]): (r[2], r[3]) for r in hamming_search.search(df, df.where("id % 20 = 0"), 4).collect()}
    for q in (0, 20, 40, 60):
        near = sorted((bin((codes[q] ^ c) & (2 ** 64 - 1)).count("1"), i) for i, c in enumerate(codes))[:4]
        assert [got[q, k + 1] for k in range(4)] == [(i, d) for d, i in near]


def test_pipeline_is_its_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    at_first = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == at_first
    want = jaccard_components([(r["doc_id"], r["text"]) for r in docs.dropDuplicates(["doc_id"]).collect()], 5, 80, 100)
    assert all(label == i for i, (_, label) in want.items())  # no near duplicates are left
    key = lambda r: (r["doc_id"], r["piece"], r["length"], r["ids_crc32"])
    assert Counter(map(key, corpus_pipeline.run(spark, sf_dir).collect())) == Counter(map(key, corpus_pipeline.packed(spark, docs, sf_dir).collect()))


@pytest.mark.parametrize("name", ["op3_licenses", "op6_urls", "op7_hamming"])
def test_queries_match_their_sql(spark, name):
    import duckdb

    from shelfwise.llm import queries

    sf_dir, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    want = con.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, sf_dir).select(*want.columns).collect()
    assert Counter(map(tuple, got)) == Counter(want.fetchall())


def brute_perplexities(rows, order=quality.ORDER):
    """Log perplexity of each (lang, text): modified Kneser-Ney with dictionaries, a model for each lang."""
    import math

    def grams(text):
        s = " " * (order - 1) + re.sub(r"[\t\n\x0b\x0c\r]", " ", text) + " "
        return [s[i:i + order] for i in range(len(s) - order + 1)]

    out = {}
    for lang in {x for x, _ in rows}:
        levels = [Counter(g for x, t in rows if x == lang and t for g in grams(t))]
        while len(next(iter(levels[-1]), "")) > 1:
            levels.append(Counter(g[1:] for g in levels[-1]))
        p = {"": 1 / max(1, len(levels[-1]))}
        for level in reversed(levels):
            have = [sum(n == k for n in level.values()) for k in range(1, 5)]
            d = [0, 0.5, 0.75, 0.9]
            if all(have):
                y = have[0] / (have[0] + 2 * have[1])
                d = [0, *(min(k, max(0.1, k - (k + 1) * y * have[k] / have[k - 1])) for k in (1, 2, 3))]
            total, left = Counter(), Counter()
            for g, n in level.items():
                total[g[:-1]] += n
                left[g[:-1]] += d[min(n, 3)]
            p = {g: (n - d[min(n, 3)] + left[g[:-1]] * p[g[1:]]) / total[g[:-1]] for g, n in level.items()}
        for x, t in rows:
            if x == lang:
                out[x, t] = -sum(math.log(p[g]) for g in grams(t)) / len(grams(t)) if t else None
    return out


def test_perplexities_of_whole_code_points(spark):
    letters = ["abcdefgh \n\x00", "абвгдежзийклмнопрстуфхцчшщъыьэюя ", "日本語中文字漢数人大小山川田口目耳手足 ", "αβγδεζηθικλμ 🎉"]
    rng = np.random.default_rng(4)
    rows = [(None if k == 2 else f"l{k}", "".join(rng.choice(list(letters[k]), int(rng.integers(1, 400))))) for k in range(4) for _ in range(12)]
    rows += [("l0", None), ("l0", ""), rows[0], rows[20]]
    df = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string").repartition(3)
    want = brute_perplexities(rows)
    for r in quality.quality(df).collect():
        w = want[rows[r["doc_id"]]]
        assert r["log_perplexity"] == (w if w is None else pytest.approx(w, abs=1e-5))


def test_chunks_of_a_task_give_the_same_perplexities():
    texts = [BASE * k for k in range(1, 9)]
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 8, "text": texts})

    class Task:
        def partitionId(self):
            return 2

    seen = []
    for most in (1, 300, 1 << 25):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(quality, "CHUNK", most)
            m.setattr(quality.TaskContext, "get", staticmethod(Task))
            total, chunks = Counter(), set()
            for b in quality.count_grams([batch, batch]):
                for row in b.to_pylist():
                    total[row["lang"], row["gram"]] += row["n"]
                    chunks.add(row["chunk"])
            seen.append(total)
            assert len(chunks) == {1: 16, 1 << 25: 1}.get(most, len(chunks))
    assert seen[0] == seen[1] == seen[2]


def test_each_of_many_languages_has_its_own_model_and_bands(spark):
    rng = np.random.default_rng(6)
    rows = []
    for k in range(11):  # l10 has the fewest rows
        syllables = ["".join(rng.choice(list("abcdefghijklmnop"), 3)) for _ in range(12)]
        for _ in range(16 - k // 3):
            rows.append((f"l{k}", " ".join("".join(rng.choice(syllables, 2)) for _ in range(int(rng.integers(55, 90))))))
    df = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    want, values = brute_perplexities(rows), {}
    got = quality.quality(df).collect()
    for r in got:
        assert r["log_perplexity"] == pytest.approx(want[rows[r["doc_id"]]], abs=1e-5)
        if not r["base_failed"]:
            values.setdefault(rows[r["doc_id"]][0], []).append(round(r["log_perplexity"] * quality.BINS))
    assert len(values) == 11
    middle = lambda v: sorted(v)[(len(v) - 1) // 2]
    for r in got:
        v = values[rows[r["doc_id"]][0]]
        wide = max(quality.WIDTH * middle([abs(x - middle(v)) for x in v]), quality.FLOOR * quality.BINS)
        if abs(abs(r["log_perplexity"] * quality.BINS - middle(v)) - wide) > 1:
            assert r["kept"] == (not r["base_failed"] and abs(r["log_perplexity"] * quality.BINS - middle(v)) < wide)


MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
APACHE = """Copyright 2020 Someone
Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL = """This program is distributed in the hope that it will be useful, but WITHOUT ANY
WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
PARTICULAR PURPOSE."""


def test_wrapped_licences(spark):
    texts = [MIT, APACHE, *("".join(f"{sign} {line}".rstrip(" ") + end for line in APACHE.split("\n")) for sign in ("#", " *", "//") for end in ("\n", "\r\n")),
             "a title\nAll rights reserved\nmore words", "all rights reserved here", "Released under\n\nthe MIT License.", "\x02All rights\nreserved! x" * 2]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [(r["sentence_ids"], r["licenses"], r["n_unmatched"]) for r in license_scan.scan(df).orderBy("doc_id").collect()]
    assert got[0] == ("mit-grant,mit-keep", "MIT", 0)
    assert got[1:8] == [("apache-header,apache-copy,as-is-basis,apache-limits", "Apache-2.0", 0)] * 7
    assert got[8] == ("rights-reserved", "Proprietary", 0) and got[9:11] == [("", "", 0)] * 2 and got[11][0] == "rights-reserved"


def test_marks_survive_what_normalisation_drops(spark):
    texts = [GPL, GPL.replace("ANY\nWARRANTY", "ANY  WARRANTY"), GPL.replace("ANY\nWARRANTY", "ANY,\tWARRANTY")]
    got = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r["sentence_ids"] for r in got] == ["gpl-hope"] * 3
    with pytest.raises(ValueError, match="mine"):
        license_scan.scan(spark.createDataFrame([], "doc_id long, text string"), sentences={"mine": "Do as you like."}, rules=[])


def test_a_copy_links_by_its_other_texts_too(spark):
    def text(name, *changed):
        return " ".join(f"x{i}" if i in changed else f"{name}{i}" for i in range(90))

    rows = [(1, text("a")), (5, text("a")), (5, text("b")), (9, text("b", 40)), (7, text("c")), (8, text("d")), (12, text("b"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"]) for r in jaccard_join.classes(df).collect()}
    assert got == {(1, 1), (5, 1), (9, 1), (12, 1), (7, 7), (8, 8)}
    assert sorted(r["doc_id"] for r in jaccard_join.one_of_each(df).collect()) == [1, 7, 8]


def test_jaccard_join_ships_neither_regions_nor_sets_that_cannot_link(spark, monkeypatch):
    def text(name, changed):
        return " ".join(f"{name}x{i}" if i < changed else f"w{i}" for i in range(6000))

    written = {}

    def stored(df, name, put=jaccard_join.stored):
        written.setdefault(name, []).append((df._jdf.queryExecution().optimizedPlan().toString(), out := put(df, name)))
        return out

    monkeypatch.setattr(jaccard_join, "stored", stored)
    rows = [(0, text("a", 0)), (1, text("b", 2400)), (2, text("c", 300)), (3, text("a", 0)), (4, text("d", 2400))]
    got = {(r["doc_id"], r["component_id"]) for r in jaccard_join.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(0, 0), (1, 1), (2, 0), (3, 0), (4, 4)}
    # Regions of rows without a copy reach their grouping without a join.
    assert all("Join" not in plan for plan, _ in written["pivots"])
    # Of long sets that share six tenths no sketch is too coarse: just the linked pair is compared by its sets.
    opened = {(r["a"], r["b"]) for _, df in written["sketched"] for r in df.where("open").collect()}
    assert opened == {(2, 0)}


def test_the_encoder_hands_new_words_to_the_library_in_groups(monkeypatch):
    """The library holds much more than the ids of a text for as long as it encodes it."""
    seen = []

    def coded(self, words, put=tokens.WordEncoder.coded):
        seen.append(len(words))
        return put(self, words)

    monkeypatch.setattr(tokens.WordEncoder, "coded", coded)
    monkeypatch.setattr(tokens, "AT_ONCE", 50, raising=False)
    encoder = tokens.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["start " + " ".join(f"wo{i}rd né{i} plain{'x' * (i % 7)}. house," for i in range(n)) for n in (0, 70, 130)]
    assert encoder.encode(texts) == encoder.whole(texts)
    assert max(seen) <= 50 and sum(seen) > 200


def test_each_task_of_the_regions_has_one_python_worker(spark, monkeypatch):
    """A second one would be kept with its memory by the executor."""
    plans = {}

    def stored(df, name, put=jaccard_join.stored):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return put(df, name)

    monkeypatch.setattr(jaccard_join, "stored", stored)
    same, near = (" ".join(f"{x if i == 7 else 'w'}{i}" for i in range(60)) for x in "wx")
    rows = [(1, same), (2, same), (2, near), (3, near)]
    got = {(r["doc_id"], r["component_id"]) for r in jaccard_join.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1), (2, 1), (3, 1)}
    assert all(plans[name].count("MapInArrow") == 1 for name in ("pivots", "members"))

"""The ten operators against brute force, round trips and held-out accuracy, with odd inputs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barloom.llm import covertree, html, jaccard, licenses, media, packing, pieces, quality, queries, samples, suffixes, toxicity

SF = "/root/testdata/sf0.001"
ODD = [(1, None, "x"), (2, "", "y"), (2, "a b", "y"), (3, " \n\t ", None), (4, "word " * 9000, "z"), (5, "é世界😀\x00<s>", "z"), (6, "a b", "q")]


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, long and repeated texts, a repeated id, and columns whose names clash with outputs."""
    df = spark.createDataFrame(ODD, "doc_id bigint, text string, n string")
    return df.withColumnsRenamed({"n": "component_id"}).selectExpr("*", "1 AS score", "2 AS ids", "3 AS spans", "4 AS length", "5 AS part")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def test_licenses(spark, odd, none):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    rows = [(1, "Text. Released under the MIT License."), (2, mit), (3, mit.replace("\n\n", "\nodd words\n")), (4, "no cue"), (5, "Licensed under the Apache License, Version 2.0.\nAll rights reserved.")]
    got = {r["doc_id"]: (r["n_known"], r["license"], r["rules"]) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: (1, "MIT", "MIT"), 2: (2, "MIT", "MIT"), 3: (2, "", ""), 4: (0, "", ""), 5: (2, "Apache-2.0", "Apache-2.0 LicenseRef-all-rights-reserved")}
    assert licenses.scan_licenses(odd).count() == len(ODD) and licenses.scan_licenses(none).isEmpty()


def test_license_cues(spark):
    assert all(re.search(licenses.CUES, s) for s in licenses.SENTENCES.values()) and " " not in licenses.CUES
    rows = [(1, "All rights  reserved."), (2, "All rights\treserved."), (3, "This work is dedicated to the public-domain under CC0 1.0 Universal.")]
    got = {r["doc_id"]: r["license"] for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: "LicenseRef-all-rights-reserved", 2: "LicenseRef-all-rights-reserved", 3: "CC0-1.0"}


NOTICES = {
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at""",
}
NOTICES["BSD-2-Clause"] = NOTICES["BSD-3-Clause"].split("\n\n3.")[0]


def test_license_notices(spark):
    want = {name: (text, name) for name, text in NOTICES.items()}
    want |= {f"# {name}": ("#!/bin/sh\n#\n" + re.sub("(?m)^", "# ", text) + "\n\ncode();", name) for name, text in NOTICES.items()}
    want |= {f"crlf {name}": (text.replace("\n", "\r\n"), name) for name, text in NOTICES.items()}
    want |= {run: (f"Text.\n{licenses.SENTENCES[run].replace(' ', chr(10), 2)}.\nText", name) for name, run in licenses.RULES if " " not in run}
    want |= {f"spdx {x}": (f"// SPDX-License-Identifier: {x}\ncode", x) for x in ("MIT", "Apache-2.0", "GPL-3.0-only")}
    want |= {x: (x, "") for x in ("All rights\n\nreserved", "All rights. Reserved.", "SPDX-License-Identifier: MIT or other", "all rights |\n | \n reserved")}
    names = list(want)
    df = spark.createDataFrame([(i, want[x][0]) for i, x in enumerate(names)], "doc_id bigint, text string")
    got = {names[r["doc_id"]]: r["license"] for r in licenses.scan_licenses(df).collect()}
    assert got == {x: name for x, (_, name) in want.items()}


def test_pieces(docs, odd, none):
    model = public_tokenizers.path(queries.PIECE_MODEL)
    enc = pieces.MergeEncoder(model)
    rng = random.Random(1)
    for text in [t for _, t in texts(docs)] + ["".join(rng.choice("ab ▁  é世\n1<s>️q😀") for _ in range(rng.randint(0, 90))) for _ in range(3000)] + [" " * 3000, "a" * 5000]:
        ids = enc.encode(text)
        assert ids == enc.library.encode(text)
    assert pieces.encode_digests(docs, model).where("NOT agrees").isEmpty()
    got = {(r["doc_id"], len(r["ids"]), r["decoded"]) for r in pieces.encode_documents(odd, model).collect()}
    assert {(1, 0, ""), (2, 0, "")} <= got and len(got) == len(ODD)
    assert pieces.encode_digests(none, model).isEmpty()


def test_pieces_in_little_memory(docs):
    enc = pieces.MergeEncoder(public_tokenizers.path(queries.PIECE_MODEL), memory=20_000)
    for text in [t for _, t in texts(docs)][:60]:
        assert enc.encode(text) == enc.library.encode(text)
        assert enc.held <= 20_000
    assert all(len(u) <= pieces.LONGEST for u in (*enc.units, *enc.inner))
    enc.rank = {}  # a broken encoder: the library's ids count, and the column says so
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["unbelievable words"])], names=["doc_id", "text"])
    enc.units.clear()
    (_, ids, decoded, agrees), = pieces._encoded(enc, iter([batch]))
    assert ids == [enc.library.encode("unbelievable words")] and decoded == ["unbelievable words"] and agrees == [False]


def test_html_layout(spark):
    page = "<title>t</title><p>one<p>two <b>bold</b><script>var a='</p>'</script><ul><li>a<li>b<ol start=3><li>c</ol></ul><table><tr><th>k<th>value<tr><td>long key<td>v</table><p hidden>no<pre>x\n  y</pre><div style='display : none'>no</div>&copy;"
    assert html.render(page) == "one\n\ntwo bold\n\n- a\n- b\n  3. c\n\nk         value\nlong key  v\n\nx\n  y\n\n©"
    assert html.render(None) == html.render("") == html.render("<script>1") == ""
    assert html.render("<div>" * 5000 + "deep") == "deep"
    df = spark.createDataFrame([(1, None, 1), (1, "<p>a", 2), (2, "<b>x" * 1000, 3)], "page_id bigint, html string, text int")
    assert html.extract_text(df).count() == 3


def test_html_text_between_cells():
    for page, want in [
        ("<table><tr><form><td>x</td></form></tr></table>", "x"),
        ("<table><tr>text<td>x</td></tr></table>", "text\nx"),
        ("<table><tr><td>a</td></tr>tail</table>", "tail\na"),
        ("<table><tr><b>one</b><td>a<tr>two<td>b</table>", "one\ntwo\na\nb"),
        ("<table><form><tr><td>a<td>b<tr><td>c</form></table>", "a  b\nc"),
        ("<table><tr><form hidden><td>no</td></form><td>a<table><tr>in<td>b</table></table>", "a\n\nin\nb"),  # cells keep their lines
        ("<table><tr><td>a<br>b<td>c<tr><td>dd<td><ul><li>e<li>f</ul></table>", "a   c\nb\ndd  - e\n    - f"),
        ("<table><caption>k</caption><colgroup>c</colgroup><tbody><p>p</p><tr><td>a</table>", None),
    ]:
        got = html.render(page)
        assert got == want if want else sorted(got.split()) == ["a", "c", "k", "p"], page
    for depth in range(185, 205):
        page = "<div>" * depth + "<table><caption>c1</caption><tr>c2<td>c3<td><ul><li>c4</ul></tr><tr><td>c5</table>c6"
        assert sorted(re.findall(r"c\d", html.render(page))) == [f"c{i}" for i in range(1, 7)], depth
    assert html.render("<table><caption>" * 60 + "x") == "x"


def test_html_of_any_depth():
    for depth in (5, 250, 5000, 30_000):
        assert html.render("<div>" * depth + "<p hidden>secret</p><p style='display: none'>secret</p><p>shown</p>") == "shown"
    for tag in ("b", "blockquote", "ul><li", "table><tr><td", "dd", "form", "table><caption", "pre", "p", "td"):
        assert html.render(f"<{tag}>" * 20_000 + "deep").split()[-1] == "deep", tag
    assert html.render("<table>" + "<form>" * 20_000 + "<td>deep") == "deep"


def test_html_lists_of_options_and_noscript():
    assert html.render("<select><option>x<option selected>y</select> <select multiple><option>p<optgroup label=g><option>q</select> <select><option>1<option>2</select>") == "y p q 1"
    assert html.render("<noscript><p>no</p></noscript><p>yes</p><noscript>no</noscript>") == "yes"
    assert html.render("<table><tr><td colspan=99999999999>a<td>b</table>").split() == ["a", "b"]


def test_top_k(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(90, 8))
    vectors = [list(map(float, base[rng.integers(90)] + (rng.random() < 0.5) * rng.normal(size=8) * 0.05)) for _ in range(700)]
    vectors[3], vectors[20], vectors[41] = None, [float("nan")] * 8, [1.0, None, *[0.0] * 6]
    vectors[60] = [1e12] * 8
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>, score int")
    want = sorted(covertree.brute_force(range(700), vectors, 20))
    for block in (64, 4096):
        got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in covertree.top_k(df, block=block).collect())
        assert got == want
    assert covertree.top_k(df.limit(0)).isEmpty()


@pytest.mark.parametrize("limit", [jaccard.Threshold(85), jaccard.Threshold(80, 100, words=5), jaccard.Threshold(60)])
def test_jaccard(spark, limit):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 6, 9, 12, 16, 20, 40, 120]))] for _ in range(25)]
    rows = []
    for i in range(500):
        words = list(base[0] if i % 3 == 0 else rng.choice(base))  # one group holds a third of the rows
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, " ".join(words)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, None)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"), limit).collect()}
    assert got == jaccard.brute_force(rows, limit)


def test_jaccard_odd(odd, none):
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(odd).collect())
    assert got == [(1, 0, 1), (2, 0, 2), (2, 1, 2), (3, 0, 3), (4, 1, 4), (5, 1, 5), (6, 1, 2)]
    assert jaccard.jaccard_components(none).isEmpty()


def test_suffixes(spark, odd, none):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(200)]
    shared = [[rng.choice(vocabulary) for _ in range(rng.randint(45, 160))] for _ in range(15)]
    rows = []
    for i in range(250):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
            a = rng.randint(0, 30)
            words += rng.choice(shared)[a : a + rng.randint(30, 160)]
        rows.append((i, " ".join(words)))
    rows += [(900, " ".join(["x"] * 300)), (901, " ".join(["x"] * 70)), (902, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = suffixes.brute_force(rows)
    got = {r["doc_id"]: [(s["a"], s["b"]) for s in r["spans"]] for r in suffixes.repeated_spans(df).collect()}
    assert got == want
    cut = {r["doc_id"]: r["text"] for r in suffixes.remove_repeats(df).collect()}
    for doc, text in rows:
        left = [w for i, w in enumerate((text or "").split()) if not any(a <= i < b for a, b in want.get(doc, []))]
        assert (cut[doc] or "").split() == left
    assert suffixes.report(odd).count() == len(ODD) and suffixes.report(none).isEmpty()


def test_suffixes_of_repeated_ids(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(70)) for x in "abcd")
    rows = [(7, a), (7, a), (5, b), (8, b), (8, c), (8, c), (9, c + " " + d), (9, d), (9, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    cut = sorted((r["doc_id"], r["text"] or "") for r in suffixes.remove_repeats(df).collect())
    assert cut[:6] == [(5, b), (7, a), (7, a), (8, ""), (8, c), (8, c)]
    left = [t.split() for i, t in cut if i == 9]
    assert len(left) == 3 and sorted(sum(left, [])) == sorted(d.split())
    got = sorted((r["doc_id"], r["n_repeated"], r["spans"], r["source_ids"]) for r in suffixes.report(df).collect())
    assert got[:6] == [(5, 0, "", []), (7, 0, "", []), (7, 0, "", []), (8, 0, "", []), (8, 0, "", []), (8, 70, "0-70", [5])]
    assert len(got) == 9 and sum(r[1] for r in got[6:]) == 140


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}
    got = {r["doc_id"]: r["toxic"] for r in toxicity.score(docs, model).collect()}
    hit = [got[d] == bool(y) for d, y in truth.items()]
    assert sum(hit) / len(hit) > 0.97
    assert list(model.thresholds) == sorted(model.thresholds)


def test_cumulative_link():
    """The fit ends where no small change of a weight or threshold makes the sample likelier."""
    rng = np.random.default_rng(4)
    x = rng.random((300, 5)) < 0.4
    latent = x @ np.array([2.0, -1.0, 0.5, 0.0, 1.0]) + rng.logistic(size=300)
    grade = np.digitize(latent, [0.5, 1.5, 3.0])
    row, col = np.nonzero(x)
    w, theta = toxicity.cumulative_link(row, col, 5, grade, 4, 3000, 0.0, 0.2)

    def likelihood(w, theta):
        link = 1 / (1 + np.exp(-(np.concatenate([[-np.inf], theta, [np.inf]])[None, :] - (x @ w)[:, None])))
        return np.log(link[np.arange(300), grade + 1] - link[np.arange(300), grade]).mean()

    best = likelihood(w, theta)
    assert list(theta) == sorted(theta)
    for k in range(5):
        assert likelihood(w + 0.05 * (np.arange(5) == k), theta) < best and likelihood(w - 0.05 * (np.arange(5) == k), theta) < best
    for k in range(3):
        assert likelihood(w, theta + 0.05 * (np.arange(3) == k)) < best and likelihood(w, theta - 0.05 * (np.arange(3) == k)) < best
    assert abs(w - [2, -1, 0.5, 0, 1]).max() < 0.8


def test_samples_are_bounded(spark):
    docs = spark.createDataFrame([(1, "a b"), *[(1, f"t{i}") for i in range(200)], *[(i, None) for i in range(2, 60)], (None, "n")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 1), (None, 1), (8, None)], "doc_id bigint, toxic int")
    rows = samples.labelled(docs, labels, "toxic", 3).collect()
    assert len(rows) <= 6 and len({r["doc_id"] for r in rows}) == len(rows) and all(r["text"] is not None for r in rows)
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 for r in samples.labelled(docs, labels, "toxic", 1000).collect())


def test_classifiers_odd(spark, odd, none):
    labels = spark.createDataFrame([(4, 1, 0), (6, None, None), (2, 0, 1), (2, 1, 0)], "doc_id bigint, quality int, toxic int")
    for module in (toxicity, quality):
        model = module.train(odd, labels)
        assert module.score(odd, model).count() == len(ODD) and module.score(none, model).isEmpty()
        assert module.train(none, labels.limit(0)) is not None
    assert set(toxicity.keep_clean(odd, toxicity.train(odd, labels)).columns) == set(odd.columns)


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    net = quality.train(docs, labels)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = [r for r in quality.score(docs, net).collect() if r["held_out"] and r["doc_id"] in truth]
    assert rows and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in rows) / len(rows) > 0.93


def test_pooling_covers_every_chunk():
    net = quality.fit([b"abcd", b"zzzz"], [0, 1], epochs=1)
    rng = np.random.default_rng(2)
    for n in (0, 3, 4, 511, 512, 513, 896, 897, 40_000):
        raw = rng.integers(0, 256, n, dtype=np.uint8).tobytes()
        b = raw if n >= 4 else raw + b"\0" * (4 - n)
        tops = []
        for a in quality.chunk_starts(len(b)):
            c = np.frombuffer(b[a : a + quality.CHUNK], np.uint8)
            h = sum(net.filters[j][c[j : len(c) - 3 + j]] for j in range(4)) + net.bias
            tops.append(np.maximum(h.max(0), 0))
        assert np.allclose(quality.pooled(raw, net.tables())[:-2], np.mean(tops, 0), atol=1e-4)


def test_packing(docs, odd, none):
    path = public_tokenizers.path(queries.BYTE_TOKENIZER)
    hf = Tokenizer.from_file(path)
    for capacity in (64, 2048):
        rows = [r.asDict() for r in packing.pack(docs, path, capacity).collect()]
        ids = {d: [*hf.encode(t, add_special_tokens=False).ids, 0] for d, t in texts(docs)}
        place, seen = {}, Counter()
        for r in rows:
            part = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and len(part) == r["length"] <= capacity
            place.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
            seen[r["doc_id"]] += r["length"]
        assert seen == {d: len(x) for d, x in ids.items()}
        for used in place.values():
            at = 0
            for offset, length in sorted(used):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(place) <= 1.02 * sum(seen.values()) / capacity + 2
    assert packing.pack(odd, path).selectExpr("sum(length)").first()[0] > len(ODD) and packing.pack(none, path).isEmpty()


def test_packing_added_tokens(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    hf = Tokenizer.from_file(path)
    rows = list(enumerate(["end <|endoftext|> next", "<|endoftext|>", "a<|endoftext|><|endoftext|>\n\n b", "<|endoftext| >", "x <|ENDOFTEXT|>", "é  <|endoftext|>  é", "word <|endoftext|> " * 900]))
    ids = {d: [*hf.encode(t, add_special_tokens=False).ids, 0] for d, t in rows}
    for r in packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string"), path, 512).collect():
        part = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and len(part) == r["length"]


def test_ids_of_odd_texts():
    """Ids by ranks are the library's; where they are not, the library's are taken."""
    path = public_tokenizers.path(queries.BYTE_TOKENIZER)
    hf, rng = Tokenizer.from_file(path), random.Random(3)
    parts = [" ", " ", "\n", "\t", "\r", "a", "bc", "'s", "'ll", "1", "2", "!", "é", "\u00a0", "\u3000", "\u200b", "\x1c", "<|endoftext|>", "世", "😀", ".", "Word"]
    encoder = packing.Ids(path)
    assert encoder.fast is not None
    for _ in range(8000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert encoder.ids(text).tolist() == hf.encode(text, add_special_tokens=False).ids, repr(text)
        assert encoder.checked(text)
    encoder.fast = packing.tiktoken.Encoding("other", pat_str=packing.PATTERN, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    assert not encoder.checked("two words") and encoder.ids("two words").tolist() == hf.encode("two words", add_special_tokens=False).ids


def fewest(lengths, capacity):
    """The least number of sequences, by trying all."""
    best = len(lengths)

    def place(k, free):
        nonlocal best
        if len(free) >= best:
            return
        if k == len(lengths):
            best = len(free)
            return
        for i in {f: i for i, f in enumerate(free) if f >= lengths[k]}.values():
            place(k + 1, [f - lengths[k] * (j == i) for j, f in enumerate(free)])
        place(k + 1, [*free, capacity - lengths[k]])

    place(0, [])
    return best


def test_plan_against_the_fewest_sequences():
    rng, more = random.Random(9), 0
    for _ in range(150):
        capacity = rng.choice([10, 12, 20])
        lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
        used = sum(times for _, times in packing.plan(Counter(lengths), capacity))
        least = fewest(lengths, capacity)
        assert least <= used <= least + 1
        more += used > least
    assert more <= 8
    # exact complements of one, two and three lengths
    for parts in ((20,), (13, 7), (9, 8, 3), (9, 5, 4, 2)):
        assert sorted(n for lengths, _ in packing.plan(Counter(parts), 20) for n in lengths) == sorted(parts)
        assert sum(times for _, times in packing.plan(Counter({n: 1000 for n in parts}), 20)) == 1000  # no sequence has room left


def test_plan_uses_all_counts():
    rng = random.Random(1)
    for _ in range(20):
        counts = Counter(rng.randint(1, 300) for _ in range(rng.choice([1, 9, 400])))
        used = Counter()
        for lengths, times in packing.plan(counts, 300):
            assert sum(lengths) <= 300
            for n in lengths:
                used[n] += times
        assert used == counts


def test_media_round_trip(docs, odd, none):
    for _, text in texts(docs):
        raw = media.padded(text.encode())
        stored = media.pack(raw)
        assert media.unpack(stored)[0] == raw
    rows = {r["doc_id"]: r for r in media.store_and_read(odd).collect()}
    assert (rows[1]["n_bytes"], rows[1]["payload_bytes"]) == (0, 64)
    both = sorted(map(str, media.media_features(media.media_column(docs)).collect())) == sorted(map(str, media.store_and_read(docs).collect()))
    assert both and media.store_and_read(none).isEmpty()


def test_media_of_several_images():
    rng = random.Random(4)
    head = "".join(rng.choice("ab cdé世") for _ in range(400_000)).encode()[: media.ROWS * media.UNIT]
    texts = [head + tail for tail in (b"", b"a" * 2000 + b"~" * 2000, b"~" * 2000 + b"a" * 2000)]
    got = [media.unpack(media.pack(media.padded(t))) for t in texts]
    assert [p for p, _ in got] == [media.padded(t) for t in texts]
    assert [f.split(":")[:2] for _, f in got] == [["512x65528", "1"], ["512x65528+512x504", "2"], ["512x65528+512x504", "2"]]
    hashes = [f.split(":")[2].split("+") for _, f in got]
    assert hashes[0][0] == hashes[1][0] == hashes[2][0] and hashes[1][1] != hashes[2][1]


def test_media_by_symbol(monkeypatch):
    samples = np.random.default_rng(0).integers(0, 256, (6, 64), dtype=np.uint8)
    image = media.encode_gray(samples)
    monkeypatch.setattr(media, "_same_stride", lambda *_: 0)
    width, height, thumb, end = media.decode_jpeg(image)
    assert (width, height, end) == (512, 48, len(image)) and (thumb == samples).all()
    with pytest.raises(ValueError):
        media.decode_jpeg(b"\xff\xd8\xff\xc2\x00\x02")


def test_pipeline_stages(spark, tmp_path):
    """Every stage against a plain version of it, each on what its predecessor kept."""
    import corpus_pipeline

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    columns, kept = docs.columns, [{r["doc_id"]: r["text"] for r in docs.collect()}]
    frames = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], SF).write.parquet(f"{tmp_path}/{k}")
        frames.append(spark.read.parquet(f"{tmp_path}/{k}"))
        if k < 4:
            assert frames[-1].columns == columns
            kept.append({r["doc_id"]: r["text"] for r in frames[-1].collect()})
    grade = toxicity.train(docs, labels)
    assert kept[1] == {d: t for d, t in kept[0].items() if grade.severity(t or "") < grade.reject}
    one = quality.scorer(quality.train(frames[1], labels))
    assert kept[2] == {d: t for d, t in kept[1].items() if one(t or "") >= quality.PASS}
    near = jaccard.brute_force(list(kept[2].items()), jaccard.Threshold(80, 100, words=5))
    assert kept[3] == {d: t for d, t in kept[2].items() if near[d][1] == d}
    spans = suffixes.brute_force(list(kept[3].items()))
    assert kept[4] == {d: suffixes.cut_words(t, [{"a": a, "b": b} for a, b in spans[d]]) if d in spans else t for d, t in kept[3].items()}
    hf = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {d: len(hf.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in kept[4].items()}
    packed = frames[5].groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in packed} == sizes
    assert sum(sizes.values()) / 2048 <= frames[5].select("sequence_id").distinct().count() <= 1.05 * sum(sizes.values()) / 2048 + 1


def test_pipeline_stages_odd(spark, none):
    """Null, blank, long and repeated texts, repeated and null ids, empty tables: each stage's defined result."""
    import corpus_pipeline

    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, long), (5, long), (5, long), (None, "a b"), (6, "x"), (6, "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "7 AS component_id", "8 AS __id", "9 AS __spans", "'z' AS source")
    stages = dict(corpus_pipeline.STAGES)
    near = stages["ngram_jaccard_join"](spark, docs, SF)
    assert near.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in near.collect()) == Counter(r for r in rows if r[0] != 5)
    cut = stages["suffix_array_dedup"](spark, docs, SF)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    assert sorted((r["doc_id"], len(r["text"].split())) for r in cut.collect() if r["doc_id"] in (4, 5)) == [(4, 3000), (5, 0), (5, 0)]
    packed = stages["best_fit_packing"](spark, docs, SF).groupBy("doc_id").agg(F.count_distinct("piece").alias("n")).collect()
    assert len(packed) == 7
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).isEmpty(), name


def test_jaccard_texts_of_one_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(7, a), (7, b), (3, b), (9, a), (11, c), (12, c), (12, "")]
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == [(3, 27, 3), (7, 27, 3), (7, 27, 3), (9, 27, 3), (11, 27, 11), (12, 0, 12), (12, 27, 11)]


def test_jaccard_large_group(spark):
    """One group of near copies and one common passage, each far beyond the length of a long list."""
    rng = random.Random(11)
    word = lambda: f"v{rng.randrange(5000)}"
    base, passage = [word() for _ in range(90)], [word() for _ in range(40)]
    rows = []
    for i in range(260):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6])):
            words[rng.randrange(len(words))] = word()
        rows.append((i, " ".join(words)))
    for i in range(260, 460):
        own = [word() for _ in range(rng.choice([2, 3, 5, 9, 20]))]
        rows.append((i, " ".join([*own, *passage[rng.choice([0, 0, 2]) :]])))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == jaccard.brute_force(rows)


def test_top_k_of_large_values(spark):
    rows = [(0, [1e9, -1e9]), (20, [1e300, 1.0]), (1, [1e9, 1e9]), (2, [-1e300, 0.0]), (3, [3.0, -0.01]), (4, [1.7e308, 1.7e308]), (5, [float("nan"), 1.0]), (6, None), (40, [0.5, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted(tuple(r[c] for c in ("query_id", "rank", "vec_id", "score")) for r in covertree.top_k(df, k=4).collect())
    assert got == sorted(covertree.brute_force([r[0] for r in rows], [r[1] for r in rows], 4))
    assert max(s for *_, s in got) == 2**63 - 1


NOTICES = {
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH\nREGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY\nAND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE",
    "AGPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
    "LGPL-2.1-or-later": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.\n\nThis library is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "EPL-2.0": "This program and the accompanying materials are made available under the\nterms of the Eclipse Public License 2.0 which is available at\nhttps://www.eclipse.org/legal/epl-2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy",
    "BSD-2-Clause": "// SPDX-License-Identifier: BSD-2-Clause\nint main() {}",
}


def test_license_notices_of_further_licences(spark):
    df = spark.createDataFrame(list(enumerate(NOTICES.values())), "doc_id bigint, text string")
    got = {r["doc_id"]: r["license"] for r in licenses.scan_licenses(df).collect()}
    assert [got[i] for i in range(len(NOTICES))] == list(NOTICES)


# The Huffman table that baseline files mostly carry for luminance DC terms; codes by length from 1 to 16, then symbols.
DC_COUNTS, DC_SYMBOLS = [0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0], list(range(12))


def jpeg(width, height, factors, restart, rng):
    """A baseline JPEG of random DC and AC terms, and the DC terms of its first component by row; written here alone."""
    ac_symbols = [0x00, 0x01, 0x02, 0x11, 0x31, 0xF0, 0x03]
    ac_counts = [0, 2, 1, 2, 0, 1, 0, 1] + [0] * 8

    def codes(counts, symbols):
        out, code, k = {}, 0, 0
        for n, c in enumerate(counts, 1):
            for _ in range(c):
                out[symbols[k]] = format(code, f"0{n}b")
                code, k = code + 1, k + 1
            code <<= 1
        return out

    dc, ac = codes(DC_COUNTS, DC_SYMBOLS), codes(ac_counts, ac_symbols)

    def number(v, s):
        return format(v if v >= 0 else v + (1 << s) - 1, f"0{s}b") if s else ""

    h, v = max(f[0] for f in factors), max(f[1] for f in factors)
    across, down = -(-width // (8 * h)), -(-height // (8 * v))
    first = {}
    scan, bits, last = b"", "", [0] * len(factors)

    def flushed():
        body = bits + "1" * (-len(bits) % 8)
        return bytes(int(body[i : i + 8], 2) for i in range(0, len(body), 8)).replace(b"\xff", b"\xff\x00")

    for m in range(across * down):
        if restart and m and m % restart == 0:
            scan += flushed() + bytes([0xFF, 0xD0 + (m // restart - 1) % 8])
            bits, last = "", [0] * len(factors)
        for c, (fh, fv) in enumerate(factors):
            for y in range(fv):
                for x in range(fh):
                    level = rng.randint(-200, 200)
                    s = abs(level - last[c]).bit_length()
                    bits += dc[s] + number(level - last[c], s)
                    last[c] = level
                    if c == 0:
                        first[m // across * fv + y, m % across * fh + x] = level
                    k = 1
                    while k < 64:
                        symbol = rng.choice([t for t in ac_symbols if k + (t >> 4) < 64])
                        bits += ac[symbol] + "".join(rng.choice("01") for _ in range(symbol & 15))
                        if symbol == 0:
                            break
                        k += (symbol >> 4) + 1
    segment = lambda marker, body: bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + bytes(body)
    out = b"\xff\xd8" + segment(0xFE, b"a comment \xff\xd8") + segment(0xDB, [0, *[4] * 64])
    out += segment(0xC0, [8, *height.to_bytes(2, "big"), *width.to_bytes(2, "big"), len(factors), *(x for c, (fh, fv) in enumerate(factors) for x in (c + 1, fh << 4 | fv, 0))])
    out += segment(0xC4, [0x00, *DC_COUNTS, *DC_SYMBOLS, 0x10, *ac_counts, *ac_symbols])
    if restart:
        out += segment(0xDD, restart.to_bytes(2, "big"))
    out += segment(0xDA, [len(factors), *(x for c in range(len(factors)) for x in (c + 1, 0)), 0, 63, 0])
    fh, fv = factors[0]
    rows, cols = -(-(-(-height * fv // v)) // 8), -(-(-(-width * fh // h)) // 8)
    return out + scan + flushed() + b"\xff\xd9", [[first[y, x] for x in range(cols)] for y in range(rows)]


def test_media_of_other_makers():
    rng = random.Random(12)
    for width, height, factors, restart in ((64, 40, [(1, 1)], 0), (70, 33, [(1, 1)], 3), (50, 50, [(2, 2), (1, 1), (1, 1)], 0), (100, 37, [(2, 2), (1, 1), (1, 1)], 2), (33, 65, [(2, 1), (1, 1), (1, 1)], 1), (8, 8, [(1, 1), (1, 1), (1, 1)], 9)):
        data, levels = jpeg(width, height, factors, restart, rng)
        got = media.decode_jpeg(data + b"more")
        want = np.clip((np.array(levels) * 4 + 4) // 8 + 128, 0, 255)
        assert got[:2] == (width, height) and got[3] == len(data) and (got[2] == want).all()
        for cut in rng.sample(range(len(data) - 2), 25):  # no cut stream passes
            with pytest.raises(ValueError):
                media.decode_jpeg(data[:cut])


def test_media_that_cannot_be_read(spark):
    good = media.pack(media.padded(b"text"))
    df = spark.createDataFrame([(1, 4, good), (2, 0, None), (3, 0, b""), (4, 0, good[:-9]), (5, 0, b"no image")], "doc_id bigint, n_bytes bigint, media binary")
    got = {r["doc_id"]: (r["payload_bytes"], r["feature"]) for r in media.media_features(df).collect()}
    assert got[1][0] == 64 and got[1][1] != "unreadable"
    assert {got[d] for d in (2, 3, 4, 5)} == {(None, "unreadable")}

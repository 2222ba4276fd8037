import random

import pytest
import regex
from pyspark.sql import functions as F

from poststream.llm import licenses as L


def _words(text):
    return regex.findall(r"[\p{L}\p{N}]+", text.lower())


def _shingles(text):
    w = _words(text)
    return [tuple(w[i: i + L.SHINGLE]) for i in range(len(w) - L.SHINGLE + 1)]


def brute(text, templates):
    """Names of the templates whose shingles stand around any place of the text."""
    sh, words, out = _shingles(text), _words(text), set()
    for name, template in templates:
        own, w = set(_shingles(template)), _words(template)
        if not own:
            if any(words[i: i + len(w)] == w for i in range(len(words))):
                out.add(name)
            continue
        m = len(own)
        if any(len(own & set(sh[max(at - m, 0): max(at - m, 0) + 2 * m + max(L.SIZES)]))
               >= L.CONTAINMENT * m for at in range(len(sh)) if sh[at] in own):
            out.add(name)
    return out


def _mixed(templates, seed, copies=3):
    """Texts that hold templates, whole, with changed words and cut, among others."""
    rng, rows = random.Random(seed), []
    for _ in range(copies):
        for _, text in templates:
            words = text.split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                words[rng.randrange(len(words))] = "other"
            if rng.random() < 0.3:
                words = words[: max(1, int(len(words) * rng.choice([0.5, 0.85])))]
            around = [[f"f{rng.randrange(500)}" for _ in range(rng.randrange(0, 60))] for _ in range(2)]
            rows.append((len(rows), " ".join(around[0] + words + around[1])))
    return rows


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.createDataFrame(_mixed(L.TEMPLATES, 5, copies=8), "doc_id long, text string")


def _names(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], set()).add(r["license"])
    return out


def test_finds_every_planted_notice_and_nothing_else(spark, docs, rows):
    got = {(r["doc_id"], r["license"]) for r in L.scan(docs).collect()}
    wording = {"Apache-2.0": "licensed under the apache license, version 2.0",
               "MIT": "released under the mit license", "CC-BY-NC-4.0": "licensed under cc by-nc 4.0",
               "GPL-3.0": "this work is licensed under the gnu general public license, version 3"}
    want = {(r["doc_id"], name) for r in rows for name, line in wording.items()
            if line in (r["text"] or "").lower()}
    assert got == want


def test_equals_brute_force_over_all_templates(mixed):
    got = _names(L.scan(mixed))
    wanted = found = 0
    for r in mixed.collect():
        want, have = brute(r["text"], L.TEMPLATES), got.get(r["doc_id"], set())
        assert have <= want
        wanted, found = wanted + len(want), found + len(have)
    assert wanted > 150 and found >= 0.99 * wanted, (wanted, found)


def test_a_table_of_templates_gives_the_same(spark, docs, mixed, monkeypatch):
    table = spark.createDataFrame(L.TEMPLATES, "name string, text string")
    for frame in (mixed, docs):
        got = sorted(tuple(r) for r in L.scan(frame, table).collect())
        assert got == sorted(tuple(r) for r in L.scan(frame).collect())
    monkeypatch.setattr(L, "PLAN_WORDS", 10)   # a longer list becomes a table
    assert sorted(tuple(r) for r in L.scan(mixed, L.TEMPLATES).collect()) == sorted(
        tuple(r) for r in L.scan(mixed, table).collect())


def test_a_list_too_long_for_a_plan(spark, tmp_path):
    rng = random.Random(2)
    texts = {f"L{i}": " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
             for i, n in enumerate([3, 4, 5, 9, 30, 1500, 2000, 6000])}
    for name, text in texts.items():
        (tmp_path / f"{name}.txt").write_text(text)
    (tmp_path / "blank.txt").write_text(" \n ")
    table = L.read_templates(spark, str(tmp_path))
    assert {r["name"] for r in table.collect()} == set(texts)
    words = texts["L7"].split()
    for i in range(0, len(words), 200):
        words[i] = "changed"
    rows = [(i, f"x y {texts[f'L{i}']} z") for i in range(8)] + [
        (8, " ".join(words)), (9, " ".join(words[:3000])), (None, texts["L4"]), (None, texts["L5"]),
        (None, texts["L5"])]
    got = L.scan(spark.createDataFrame(rows, "doc_id long, text string"), table).collect()
    assert {(r["doc_id"], r["license"]) for r in got} == {(i, f"L{i}") for i in range(8)} | {
        (8, "L7"), (None, "L4"), (None, "L5")}
    assert all(r["containment"] == 1.0 for r in got if r["doc_id"] != 8)


def test_bands_collide_as_often_as_stated(spark):
    rng, pairs, n = random.Random(3), [], 6000
    for shared in (2, 3):
        for i in range(n):
            x = [rng.getrandbits(63) for _ in range(8 - shared)]
            pairs.append((shared, x[:4], x[: shared] + x[4:]))
    df = spark.createDataFrame(pairs, "shared int, a array<long>, b array<long>")
    for side in "ab":
        df = L._orders(df, side, [4])
        for band in range(L.BANDS):
            df = df.withColumn(f"{side}{band}", F.array_min(f"o_{band}"))
    hit = F.greatest(*[(F.col(f"a{b}") == F.col(f"b{b}")).cast("int") for b in range(L.BANDS)])
    for r in df.groupBy("shared").agg(F.avg(hit).alias("p")).collect():
        stated = L.collision_probability(r["shared"] / (8 - r["shared"]))
        assert abs(r["p"] - stated) < 0.02, r


def test_identifier_lines(spark):
    frame = spark.createDataFrame([
        (1, "// SPDX-License-Identifier: MIT\nint main"), (2, "spdx-license-identifier mit"),
        (3, "SPDX-License-Identifier: GPL-3.0-or-later"), (4, "SPDX License"), (5, "MIT")],
        "doc_id long, text string")
    assert _names(L.scan(frame)) == {1: {"MIT"}, 2: {"MIT"}, 3: {"GPL-3.0-or-later"}}


def test_changed_words_and_places(spark):
    mit = [t for n, t in L.TEMPLATES if t.startswith("Permission is hereby granted, free of charge, to any person obtaining a copy of this")][0]
    words = mit.split()
    one = " ".join(words[:20] + ["CHANGED"] + words[21:])
    half = " ".join(words[: len(words) // 2])
    filler = " ".join(f"w{i}" for i in range(300))
    frame = spark.createDataFrame(
        [(1, f"{filler} {mit} {filler}"), (2, f"x {one}"), (3, half + " " + filler),
         (4, f"{mit}\n{filler}\n{mit.upper()}"), (5, None), (6, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in L.scan(frame).collect()}
    assert set(got) == {1, 2, 4} and all(r["license"] == "MIT" for r in got.values())
    assert got[1]["containment"] == 1.0 and abs(got[1]["first_word"] - 300) <= 16 and 0.8 <= got[2]["containment"] < 1


def test_every_template_is_found_at_every_offset(spark):
    rows = [(k * 100 + i, " ".join(f"p{j}" for j in range(k)) + " " + text + " end of it")
            for i, (_, text) in enumerate(L.TEMPLATES) for k in range(9)]
    got = {(r["doc_id"], r["license"]) for r in L.scan(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {(k * 100 + i, n) for i, (n, _) in enumerate(L.TEMPLATES) for k in range(9)} <= got


def test_limits(spark, no_docs, docs):
    assert L.scan(no_docs).count() == 0
    assert L.scan(no_docs, spark.createDataFrame(L.TEMPLATES, "name string, text string")).count() == 0
    for none in ([("x", "?!")], spark.createDataFrame([("x", "?!")], "name string, text string")):
        assert L.scan(docs, none).count() == 0
    assert L.collision_probability(0.75) > 0.99 and L.collision_probability(0.5, windows=2) > 0.99

"""Line dedup against brute force."""

from __future__ import annotations

import random

from odd_inputs import make_docs, no_docs, odd_docs  # noqa: F401

from tradelanes.llm import lines


def plain(rows, least):
    """Cleaned texts, when every (id, text) is there once and no text is null."""
    sites, first = {}, {}
    for i, text, _, site in rows:
        for pos, line in enumerate(text.split("\n")):
            if line.strip(" \t\r\f"):
                sites.setdefault(line, set()).update({site} - {None})
                first[line] = min(first.get(line, (i, pos)), (i, pos))
    return {i: "\n".join(x for pos, x in enumerate(t.split("\n")) if len(sites.get(x, ())) < least or first[x] == (i, pos)) for i, t, _, _ in rows}


def test_lines_at_and_around_the_threshold(make_docs):
    rng = random.Random(1)
    common = [f"common line {k}" for k in range(12)]  # line k is on k sites
    rows = []
    for i in range(400):
        site = i % 13
        body = [f"own line {i} {j}" for j in range(rng.randint(0, 4))] + [common[k] for k in range(12) if site < k and rng.random() < 0.9] + ["", " "]
        rng.shuffle(body)
        rows.append((i, "\n".join(body), "en", f"site{site}"))
    for least in (2, 5, 8):
        got = {r.doc_id: r.clean for r in lines.dedup_lines(make_docs(rows), least).select("row.doc_id", "clean").collect()}
        assert got == plain(rows, least)


def test_many_sites_use_the_sketch(spark):
    """300 sites: far above the threshold the sketch decides alone; around 40 the exact count does."""
    rows = [(h, f"s{s}", (s, 0, 0)) for h, n in ((1, 300), (2, 41), (3, 40), (4, 39), (5, 3)) for s in range(n) for _ in range(2)]
    frame = spark.createDataFrame(rows, "h long, site string, place struct<id:long,key:long,pos:int>")
    assert sorted(r.h for r in lines.boilerplate(frame, 40).collect()) == [1, 2, 3]


def test_copies_on_many_sites_keep_one_whole(make_docs):
    rows = [(i, "line one of it\nline two of it", "en", f"s{i % 8}") for i in range(64)]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.clean) for r in lines.dedup_lines(make_docs(rows), 5).select("row.doc_id", "n_lines", "n_removed", "clean").collect()}
    assert got == {i: (2, 0, "line one of it\nline two of it") if i == 0 else (2, 2, "") for i in range(64)}


def test_odd_inputs(odd_docs, no_docs):
    out = lines.dedup_lines(odd_docs, 2)
    rows = out.select("row.*", "n_lines", "n_removed", "clean").collect()
    assert len(rows) == 12 and out.select("row.*").columns == odd_docs.columns
    by = {(r.doc_id, r.text): (r.n_lines, r.n_removed, r["clean"]) for r in out.select("row.doc_id", "row.text", "n_lines", "n_removed", "clean").collect()}
    shared = "The quick brown fox jumps over the lazy dog today.\nAll rights reserved here."
    assert by[1, shared] == (2, 0, shared) and by[2, shared] == (2, 2, "")
    assert by[3, None] == (0, 0, None) and by[None, None] == (0, 0, None) and by[4, ""] == (1, 0, "") and by[5, " \n\t "] == (2, 0, " \n\t ")
    assert lines.dedup_lines(no_docs, 2).count() == 0

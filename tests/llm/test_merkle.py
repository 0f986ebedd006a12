"""The Merkle manifest against a plain recursive one."""

from __future__ import annotations

import hashlib
import zlib

from odd_inputs import docs_frame, make_docs, no_docs, odd_docs, odd_rows  # noqa: F401
from pyspark.sql import functions as F

from tradelanes.llm import merkle
from tradelanes.llm.queries import LOWER, UPPER, fold


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    doc_id, text, lang, source = row
    fields = [doc_id, source, lang, None if text is None else len(text), text]
    return h("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([h("".join(found[-1][i:i + 16])) for i in range(0, len(found[-1]), 16)])
    return found


def plain(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root) of every row, all nodes built again for every edit's path."""
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted((r for r in rows if r[3] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = own, levels([leaf(r) for r in own])
    top = levels([trees[s][1][-1][0] for s in sources])
    out = []
    for place, s in enumerate(sources):
        own, up = trees[s]
        for at, row in enumerate(own):
            edit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[1] is not None
            node = leaf((row[0], row[1].translate(str.maketrans(UPPER, LOWER)), row[2], row[3])) if edit else leaf(row)
            proof = ""
            for tree, i in ((up, at), (top, place)):
                for level in tree[:-1]:
                    first = i // 16 * 16
                    before, after = "".join(level[first:i]), "".join(level[i + 1:first + 16])
                    proof, node, i = proof + before + after, h(before + node + after), i // 16
            out.append((row[0], leaf(row), up[-1][0], top[-1][0], h(proof), node))
    return out


def built(docs):
    return merkle.build(docs, F.when(fold(5) == 0, F.translate("text", UPPER, LOWER)))


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
key = lambda r: tuple((x is not None, x) for x in r)


def test_manifest_equals_plain_tree(spark):
    # A source of several blocks with a last block of one leaf, sources of 1, 16, 17 and 300 leaves, one without a name
    sizes = {"hot": 2 * 4096 + 1, "one": 1, "run": 16, "more": 17, "é": 300, None: 5, "": 2}
    rows, i = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            rows.append((i * 7 % 100_003, f"Text {i}é ÀB", None if i % 11 == 0 else "en", s))
            i += 1
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    manifest = built(docs)
    got = [tuple(r) for r in manifest.proofs().select(*COLUMNS).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)
    assert manifest.root == got[0][3]
    # Versions copy the path of the edited leaf alone, and end in the folded root
    copies = manifest.versions().groupBy("doc_id").agg(F.count("*").alias("n"), F.max_by("node", "level").alias("top")).collect()
    folded = {r[0]: r[5] for r in got}
    assert {r.doc_id for r in copies} == {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0}
    assert all(r.top == folded[r.doc_id] and r.n <= 1 + 4 + 1 for r in copies)


def test_manifest_of_many_sources(spark):
    rows = [(i, f"T{i}", "en", f"s{i % 700}") for i in range(1400)]
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(map(tuple, built(docs).proofs().select(*COLUMNS).collect()), key=key) == sorted(plain(rows), key=key)


def test_manifest_takes_odd_inputs(spark, odd_docs, no_docs):
    """Nulls, empty and long texts, repeated rows and ids, clashing columns; an empty table has no rows and no root."""
    got = [tuple(r) for r in built(odd_docs).proofs().select(*COLUMNS).collect()]
    assert sorted(got, key=key) == sorted(plain(odd_rows()), key=key)
    nothing = built(no_docs)
    assert nothing.proofs().count() == 0 and nothing.versions().count() == 0 and nothing.root is None
    alone = built(odd_docs.where("doc_id = 4")).proofs().collect()[0]
    assert alone.leaf == alone.subroot == alone.root == alone.folded_root and alone.proof_sha256 == h("")


def test_place_in_group_over_range_partitions(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"), "id")
    got = merkle.numbered(rows.repartition(7), "g", ["id"]).collect()
    ids = {}
    for r in sorted(got, key=lambda r: r.id):
        ids.setdefault(r.g, []).append(r)
    assert all([r["at"] for r in of] == list(range(len(of))) and {r["total"] for r in of} == {len(of)} for of in ids.values())

"""Merkle manifest against a plain recursive version."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from rivulet.llm import merkle
from rivulet.llm.common import ascii_lower
from tests_llm_tools import empty


def h(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def leaf(row: tuple) -> str:
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes: list[str], fanout: int) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + fanout])) for i in range(0, len(out[-1]), fanout)])
    return out


def siblings(tree: list[list[str]], at: int, fanout: int) -> list[tuple[str, str]]:
    sides = []
    for nodes in tree[:-1]:
        start = at // fanout * fanout
        sides.append(("".join(nodes[start:at]), "".join(nodes[at + 1:start + fanout])))
        at //= fanout
    return sides


def plain(rows: list[tuple], fanout: int, tampered) -> list[tuple]:
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: b"" if s is None else b"s" + s.encode())
    trees = {}
    for source in order:
        groups[source].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[source] = levels([leaf(r) for r in groups[source]], fanout)
    top = levels([trees[s][-1][0] for s in order], fanout)
    root, out = top[-1][0], []
    for g, source in enumerate(order):
        for at, row in enumerate(groups[source]):
            sides = siblings(trees[source], at, fanout) + siblings(top, g, fanout)
            folded = leaf((*row[:4], lower(row[4]))) if tampered(row[0]) else leaf(row)
            for left, right in sides:
                folded = h(left + folded + right)
            out.append((row[0], leaf(row), trees[source][-1][0], root, h("".join(a + b for a, b in sides)),
                        folded, folded == root))
    return out


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def sort(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize(("fanout", "block_levels", "sizes"), [
    (16, 3, [1, 15, 16, 17]), (2, 1, [1, 2, 3, 21]), (3, 1, [28, 10, 1, 1, 1, 5]), (2, 2, [1]), (3, 2, [9, 10, 83])])
def test_against_plain_trees(spark, fanout, block_levels, sizes):
    rows = [(i * 100 + g, None if g == 0 else f"s{g}", "en", i, f"Text É {i % 3}")
            for g, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    found = merkle.manifest(docs.repartition(5), altered={"text": ascii_lower(F.col("text"))},
                            altered_where=F.col("doc_id") % 5 == 0, fanout=fanout, block_levels=block_levels)
    got = [tuple(r) for r in found.collect()]
    assert sort(got) == sort(plain(rows, fanout, lambda i: i % 5 == 0))
    assert {r[6] for r in got if r[0] % 5 == 0} == {False} or not any(r[0] % 5 == 0 for r in rows)
    assert all(r[6] for r in got if r[0] % 5)


def test_butterfly_gives_every_partition_its_siblings(spark):
    nodes = [("x", i, 23, h(str(i))) for i in range(23)] + [("y", 0, 1, h("y"))] + [
        ("z", i, 64, h(f"z{i}")) for i in range(64)]
    found = merkle.butterfly(spark.createDataFrame(nodes, "grp string, blk bigint, n bigint, h string"), fanout=4)
    for r in found.collect():
        own = [n[3] for n in nodes if n[0] == r["grp"]]
        tree = levels(own, 4)
        assert r["root"] == tree[-1][0]
        assert r["proof"] == [a + b for a, b in siblings(tree, r["blk"], 4)]


def test_messy_rows(spark, messy):
    found = merkle.manifest(messy, fanout=2, block_levels=1, with_proofs=True)
    rows = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in messy.collect()]
    got = found.collect()
    assert sort([tuple(r)[:7] for r in got]) == sort(plain(rows, 2, lambda i: False))
    for r in got:
        folded = r["leaf"]
        for text, at in zip(r["proof"], r["places"]):
            folded = h(text[:64 * at] + folded + text[64 * at:])
        assert folded == r["root"]
    assert merkle.manifest(empty(messy)).collect() == []
    # Ids that repeat with different texts: leaves stand in a fixed order, whatever the partitions are.
    again = merkle.manifest(messy.repartition(7), fanout=2, block_levels=1).select("doc_id", "proof_sha256", "leaf")
    assert sort(again.collect()) == sort(found.select("doc_id", "proof_sha256", "leaf").collect())


def test_long_text_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a", "x" * 2_000_000, 1), (2, "a", "y", 2)],
                                 "doc_id bigint, source string, text string, rows int")
    docs = docs.withColumns({c: F.lit("z") for c in ("grp", "pos", "n", "blk", "id", "leaf", "row", "root")})
    found = {r["doc_id"]: r for r in merkle.manifest(docs, hashed=["doc_id", "text"]).collect()}
    assert found[1]["leaf"] == leaf((1, "x" * 2_000_000))
    assert found[1]["root"] == h(found[1]["subroot"]) or found[1]["root"] == found[1]["subroot"]
    assert all(r["verified"] for r in found.values())

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ebbtide.llm import common, merkle_manifest as mm

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(doc_id, source, lang, n_chars, text):
    return h(*[field(v) for v in (doc_id, source, lang, n_chars, text)])


def tree(leaves, fanout=2):
    """Root, and for each leaf its steps (left, right)."""
    steps, nodes, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        for j, i in enumerate(at):
            a = i - i % fanout
            steps[j].append(("".join(nodes[a:i]), "".join(nodes[i + 1 : a + fanout])))
            at[j] = i // fanout
        nodes = [h(*nodes[a : a + fanout]) for a in range(0, len(nodes), fanout)]
    return nodes[0], steps


def brute(rows, fanout=2):
    """(doc_id, leaf, subroot, root, proof digest, folded root, verified) of each row."""
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    inner = {}
    for name in names:
        mine = sorted(langs[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        inner[name] = (mine, *tree([leaf(*r) for r in mine], fanout))
    root, upper = tree([inner[n][1] for n in names], fanout)
    out = []
    for k, name in enumerate(names):
        mine, sub, steps = inner[name]
        for r, path in zip(mine, steps):
            path = path + upper[k]
            now = leaf(*r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                now = leaf(*r[:3], None if r[3] is None else r[3] + 1, r[4])
            for left, right in path:
                now = h(left, now, right)
            out.append((r[0], leaf(*r), sub, root, h(*[a + b for a, b in path]), now, now == root))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


def write(spark, tmp_path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in common.table(spark, sf_dir, "documents").select(*mm.FIELDS).collect()]
    got = [tuple(r) for r in mm.op11_merkle_manifest(spark, sf_dir).collect()]
    assert order(got) == order(brute(rows))
    assert 0 < sum(r[6] for r in got) < len(got)


def manifest_of(spark, rows, **how):
    docs = spark.createDataFrame(rows, SCHEMA)
    leaves = docs.select("doc_id", "lang", mm.leaf_digest(*[F.col(c) for c in mm.FIELDS]).alias("leaf"))
    told = mm.manifest(leaves, F.col("lang"), F.col("doc_id"), **how)
    return told.withColumn("folded", mm.fold(F.col("leaf"), F.col("proof"))).withColumn("all", mm.siblings(F.col("proof"))).collect()


@pytest.mark.parametrize(("fanout", "levels"), [(2, 1), (2, 2), (3, 1), (5, 1)])
def test_partitions_of_any_number_exchange_their_roots(spark, fanout, levels):
    """Small partitions, so that the exchange has several rounds and short last runs."""
    rows = [(i, "s", "hot" if i < 75 else f"l{i % 4}" if i < 95 else None, i, f"t{i}") for i in range(101)]
    want = {r[0]: r for r in brute(rows, fanout)}
    got = manifest_of(spark, rows, fanout=fanout, levels=levels)
    assert len(got) == len(rows)
    for r in got:
        _, digest, sub, root, proof, _, _ = want[r["doc_id"]]
        assert (r["leaf"], r["subroot"], r["root"], h(r["all"]), r["folded"]) == (digest, sub, root, proof, root)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 9, 17])
def test_few_rows(spark, n):
    rows = [(i, None, "a", 1, "x") for i in range(n)]
    want = brute(rows)
    got = manifest_of(spark, rows, levels=1)
    assert {(r["doc_id"], r["root"], h(r["all"]), r["folded"]) for r in got} == {(w[0], w[3], w[4], w[3]) for w in want}


def test_nulls_repeats_long_texts_and_clashing_columns(spark, tmp_path):
    rows = [(i % 9 if i % 5 else None, "s" if i % 3 else None, [None, "", "é", "zz"][i % 4], None if i % 7 == 0 else i, None if i % 6 == 0 else "" if i % 6 == 1 else "ü" * i) for i in range(60)]
    rows += [(3, "s", "zz", 1, "same")] * 40 + [(70, "s", "long", 10**6, "word " * 200_000)]
    schema = SCHEMA + ", grp string, pos int, leaf string, proof string, chunk long"
    extra = [(*r, "g", 1, "leaf", "p", 4) for r in rows]
    got = [tuple(r) for r in mm.op11_merkle_manifest(spark, write(spark, tmp_path, extra, schema)).collect()]
    assert order(got) == order(brute(rows))


def test_empty_table(spark, tmp_path):
    out = mm.op11_merkle_manifest(spark, write(spark, tmp_path, []))
    assert out.count() == 0 and out.columns[0] == "doc_id"

import hashlib
import zlib

import pytest

from tilth.llm.merkle import manifest, tamper_report

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf int, idx string, key string, root int, path string"
LOWER = {i: i + 32 for i in range(65, 91)}


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(doc, text):
    fields = [doc[0], doc[3], doc[2], doc[4], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree(nodes):
    """(root, siblings of each node as one list per level of (left, right))."""
    paths = [[] for _ in nodes]
    owners = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, own = [], []
        for a in range(0, len(nodes), 16):
            run = nodes[a : a + 16]
            for s in range(len(run)):
                for i in owners[a + s]:
                    paths[i].append(("".join(run[:s]), "".join(run[s + 1 :])))
            up.append(sha("".join(run)))
            own.append(sum(owners[a : a + 16], []))
        nodes, owners = up, own
    return nodes[0], paths


def plain(docs):
    groups = {}
    for d in docs:
        groups.setdefault(d[3], []).append((d, leaf(d, d[1])))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    found = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0][0] is not None, r[0][0] or 0, r[1]))
        found[s] = tree([h for _, h in groups[s]])
    root, tops = tree([found[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        for (d, h), path in zip(groups[s], found[s][1]):
            path = path + top
            tampered = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 5 == 0
            digest = leaf(d, d[1].translate(LOWER) if tampered and d[1] is not None else d[1])
            for left, right in path:
                digest = sha(left + digest + right)
            out.append((d[0], h, found[s][0], root, sha("".join(a + b for a, b in path)), digest, digest == root))
    return out


def check(spark, docs):
    frame = spark.createDataFrame([(*d, 1, "x", "y", 2, "z") for d in docs], SCHEMA)
    got = [tuple(r) for r in tamper_report(frame).collect()]
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(got, key=key) == sorted(plain(docs), key=key)
    return got


def test_matches_trees_built_in_python(spark):
    docs = [(i, f"Text {i} É", "en", f"src{i % 3}", i) for i in range(7, 900) if i % 7]  # three levels in a source
    docs += [(i, "one", None, f"lone{i}", None) for i in range(1000, 1030)]  # two levels of subroots
    docs += [(2001, None, "de", None, 5), (2002, "", None, None, None), (2003, "Ä" * 70000, "de", "Ünï", 3), (2004, "lower", "", "", 0)]
    docs += [(None, "No id", "en", "src1", 1), (None, "Other", "en", "src1", 1), (9, "Again", "en", "src0", 1), docs[1], docs[1], (-3, "Minus", "en", "src0", 1)]
    got = check(spark, docs)
    assert 0 < sum(not r[-1] for r in got) < len(got)


@pytest.mark.parametrize("sizes", [(1,), (17,), (16, 16), (257, 1)])
def test_edges_of_runs(spark, sizes):
    check(spark, [(1000 * s + i, "Aa", "en", f"s{s}", 1) for s, n in enumerate(sizes) for i in range(n)])


def test_equal_rows_and_one_hot_source(spark):
    check(spark, [(5, "Same", "en", "hot", 1)] * 300 + [(i, "Aa", "en", "hot", 1) for i in range(100)])


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert tamper_report(empty).count() == 0
    assert manifest(empty, fields=("doc_id", "text")).columns == ["doc_id", "leaf", "claimed", "subroot", "root", "path"]

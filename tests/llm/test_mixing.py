import re

import pandas as pd
import pytest

from tilth.llm.mixing import draws_of, mix, mix_report, mixed, schedule, targets, word_counts


def plain_targets(sizes):
    """Water level by steps: cap what is above, share the rest anew."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def corpus(n=300):
    sources = ["b", "a", None, "zé", "Z", "tiny", ""]
    rows = []
    for i in range(n):
        s = "b" if i % 3 == 0 else sources[i % 7]
        rows.append((i, " ".join(["w"] * (i * 37 % 400)) if i % 11 else None, s if s != "tiny" or i < 30 else "b"))
    rows.append((n, "word " * 9000, "a"))
    return rows


@pytest.mark.parametrize("n", [300, 2])
def test_report_meets_targets(spark, n):
    rows = corpus(n)
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "source"]).assign(size="clash", number=1, slot=2)
    docs = spark.createDataFrame(frame, "doc_id long, text string, source string, size string, number long, slot long")
    got = mix_report(docs).toPandas()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    total = {}
    for i, s in source.items():
        total[s] = total.get(s, 0) + size[i]
    want = plain_targets(total)
    taken = {}
    for r in got.itertuples():
        assert r.size == size[r.doc_id] and r.source_size == total[source[r.doc_id]]
        assert abs(r.target - want[source[r.doc_id]]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    assert len(got) == len(rows)
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)
    again = mix_report(docs.repartition(7)).toPandas()
    assert got.sort_values("doc_id")["taken"].tolist() == again.sort_values("doc_id")["taken"].tolist()


def test_schedule_is_spread_evenly(spark):
    plan = spark.createDataFrame([(0, 500), (1, 300), (2, 7), (3, 0)], "number long, draws long")
    got = schedule(plan, spark).toPandas()
    assert got.groupby("number").size().to_dict() == {0: 500, 1: 300, 2: 7}
    assert got["slot"].is_unique
    early = got[got.slot < 400].groupby("number").size()
    assert abs(early[0] - 400 * 500 / 807) < 6 and abs(early[1] - 400 * 300 / 807) < 6
    assert sorted(got[got.number == 0]["rank"]) == list(range(500))


def test_uses_are_whole_or_cut(spark):
    docs = spark.createDataFrame([(i, "a\tb  c " * (40 + i), f"s{i % 4}", 1, "x") for i in range(60)] + [(99, None, "s1", None, None)], "doc_id long, text string, source string, n_chars int, slot string")
    out = mixed(docs)
    assert out.columns == docs.columns
    words = sum(len(r.text.split()) for r in out.collect())
    assert words == round(targets(word_counts(docs)).toPandas()["target"].round().sum())
    assert mixed(docs.where("false")).count() == 0
    assert mix_report(docs.where("text is null")).collect()[0].taken == 0
    pieces, _ = mix(word_counts(docs))
    assert pieces.where("word_from < 0 or word_to <= word_from").count() == 0


def test_draws_of_many_slots(spark):
    draws = [0, 1_000_000_007, 1, 0, 2_500_000_000, 13]
    plan = spark.createDataFrame(list(enumerate(draws)), "number long, draws long")
    total = sum(draws)
    firsts = [sum(draws[:i]) for i in range(len(draws))]
    ids = sorted({i + d for i in [*firsts, total] for d in range(-3, 4) if 0 <= i + d < total} | set(range(0, total, 99_999_989)))
    got = draws_of(spark.createDataFrame([(i,) for i in ids], "id long"), plan, total).collect()
    owner = {i: max(n for n, f in enumerate(firsts) if f <= i and draws[n]) for i in ids}
    assert sorted(map(tuple, got)) == sorted((owner[i], i - firsts[owner[i]]) for i in ids)


def test_rows_of_one_id_are_documents_of_their_own(spark):
    rows = [(1, "w " * 100, "a"), (1, "v " * 100, "a"), (1, "w " * 100, "a"), (1, "x " * 900, "b"), (None, "w", "a"), (1, None, "a"), (2, "y " * 7000, "b")]
    docs = spark.createDataFrame(rows * 3, "doc_id long, text string, source string")
    got = mix_report(docs).toPandas()
    assert len(got) == 18
    assert (got["taken"] <= 3 * got["size"]).all()
    total = {}
    for r in got.itertuples():
        total.setdefault((r.source_size, r.target), []).append(r.taken)
    assert len(total) == 2
    assert all(abs(sum(t) - target) <= 0.5 for (_, target), t in total.items())
    out = mixed(docs)
    assert out.columns == docs.columns
    used = {}
    for r in out.collect():
        used[r.text[0]] = used.get(r.text[0], 0) + len(r.text.split())
    report = got.groupby("size")["taken"].sum()
    assert used["w"] + used["v"] == report[100] and used["x"] == report[900] and used["y"] == report[7000]
    assert sorted(got["taken"]) == sorted(mix_report(docs.repartition(5)).toPandas()["taken"])

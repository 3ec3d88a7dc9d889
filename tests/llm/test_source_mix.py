import re
from collections import defaultdict

from panelfactors.llm.source_mix import mix, mix_copies, op6_source_mix, pivotal, source_targets
from tests.conftest import SF_SMALL
from tests.llm.conftest import docs_frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """Share by weight, cut at the cap, reshare the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, target, full = 1.5 * sum(sizes.values()), {}, set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        open_w = sum(w[s] for s in names if s not in full)
        target = {s: 2.0 * sizes[s] if s in full else left * w[s] / open_w for s in names}
        over = {s for s in names if s not in full and target[s] > 2 * sizes[s]}
        if not over:
            return target
        full |= over


def test_targets(spark):
    for sizes in ({"b": 10, "a": 1000, "c": 5, None: 700, "Z": 30, "é": 1}, {"a": 0, "b": 0}, {"x": 5}, {"a": 0, "b": 50}):
        got = source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
        want = brute_targets(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
        assert len(got) == len(sizes)
        for r in got:
            assert abs(r.target - want[r.source]) < 1e-6, (sizes, r)


def check(rows, texts, sources):
    by = defaultdict(lambda: [0, 0.0, 0])
    sizes = defaultdict(int)
    for t, s in zip(texts, sources):
        sizes[s] += len(WORD.findall(t or ""))
    want = brute_targets(sizes)
    largest = max(len(WORD.findall(t or "")) for t in texts)
    for r in rows:
        assert r.size == len(WORD.findall(texts[r.doc_id] or ""))
        assert r.taken <= 2 * r.size and (not r.size or r.taken % r.size == 0)
        assert abs(r.target - want[sources[r.doc_id]]) < 1e-6 and r.source_size == sizes[sources[r.doc_id]]
        by[sources[r.doc_id]][2] += r.taken
    for s, (_, _, taken) in by.items():
        assert abs(taken - want[s]) <= largest + 1e-6, s


def test_taken_words_come_near_the_target(spark):
    texts = [" ".join(["w"] * (1 + i * 37 % 91)) for i in range(3000)] + [None, "", "w " * 9000]
    sources = ["hot" if i % 3 == 0 else f"s{i % 4}" if i % 7 else None for i in range(len(texts))]
    df = docs_frame(spark, texts, sources, extra={"key": "k", "w": "w", "p": "p", "target": "t"})
    rows = mix_copies(df).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert len(rows) == len(texts)
    check(rows, texts, sources)
    again = mix_copies(df.repartition(7)).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_each_unit_keeps_its_probability(spark):
    units = spark.createDataFrame([("s", f"k{i}", float(1 + i % 13), 0.3) for i in range(40)],
                                  "source string, key string, w double, p double")
    total = defaultdict(int)
    for seed in range(12):
        rows = pivotal(units, seed, chunk=8).collect()
        assert len(rows) == 40
        words = sum((1 + int(r.key[1:]) % 13) * r.up for r in rows)
        assert abs(words - 0.3 * sum(1 + i % 13 for i in range(40))) <= 13
        for r in rows:
            total[r.key] += r.up
    assert 0.2 < sum(total.values()) / 480 < 0.4 and max(total.values()) < 12


def test_mix_repeats_rows_and_keeps_columns(spark):
    texts = ["one two three"] * 6 + ["four five"] * 6
    df = docs_frame(spark, texts, ["a"] * 6 + ["b"] * 6, ids=[1, 1, 2, None, 4, 5, 6, 7, 8, 9, 10, 11], extra={"mix_key": "x"})
    out = mix(df)
    assert out.columns == df.columns
    copies = mix_copies(df)
    assert out.count() == copies.agg({"copies": "sum"}).first()[0]
    assert mix(df.limit(0)).count() == 0 and mix_copies(df.limit(0)).count() == 0


def test_query(spark, sample_texts):
    rows = op6_source_mix(spark, SF_SMALL).collect()
    ids = sorted(sample_texts)
    assert ids == list(range(len(ids)))
    check(rows, [sample_texts[i]["text"] for i in ids], [sample_texts[i]["source"] for i in ids])


def test_repeated_rows_are_units_of_their_own(spark):
    """One row repeated in half or nine tenths of a source: the words taken still come near the target."""
    for times in (500, 900):
        texts = ["same " * 100] * times + [f"w{i} " * 100 for i in range(1000 - times)] + ["x " * 100] * 3 + ["y " * 100] * 600
        sources = ["a"] * 1000 + ["b"] * 3 + [None] * 600
        ids = [7] * times + list(range(100, 1100 - times)) + [7, 7, None] + [None] * 600
        df = docs_frame(spark, texts, sources, ids=ids, extra={"n": "n", "_row": "r"}).repartition(5)
        rows = mix_copies(df).collect()
        assert len(rows) == len(texts)
        by_source, by_key = defaultdict(list), defaultdict(list)
        for r in rows:
            by_source[r.source_size, r.target].append(r.taken)
            by_key[r.key].append(r.copies)
        assert sorted(size for size, _ in by_source) == [300, 60000, 100000]
        for (size, target), taken in by_source.items():
            assert abs(sum(taken) - target) <= 100 and max(taken) <= 200, (size, target, sum(taken))
        assert all(max(c) - min(c) <= 1 for c in by_key.values())
        out = mix(df)
        assert out.columns == df.columns
        taken = {r["source"]: r["n"] for r in out.groupBy("source").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
        assert sum(taken.values()) == sum(r.copies for r in rows)
        assert mix_copies(df.repartition(3)).agg({"taken": "sum"}).first()[0] == sum(r.taken for r in rows)

from collections import Counter

import corpus_pipeline
from adpulse.llm import common, mixing, quality_model, queries, simhash

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = common.documents(spark, SF)
    columns = docs.columns
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = common.stored(stage(spark, before, SF), "test-stage")
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
        kept[name] = ([tuple(r) for r in before.select(columns).collect()], [r for r in docs.collect()])

    before, after = kept["quality classifier"]
    model, _ = quality_model.fit(common.documents(spark, SF))
    good = {r.doc_id for r in quality_model.quality(common.documents(spark, SF), model).where("kept").collect()}
    assert {r.doc_id for r in after} == good and len(after) < len(before)

    before, after = kept["exact dedup"]
    last = {}
    for r in before:
        last[r[1]] = max(r[0], last.get(r[1], r[0]))
    assert {(r.text, r.doc_id) for r in after} == set(last.items()) and len(after) == len(last)

    before, after = kept["SimHash near-dedup"]
    prints = {r[0]: simhash.fingerprint(r[1]) & (1 << 64) - 1 for r in before}
    alone = [i for i, x in prints.items() if not any(j < i and bin(x ^ y).count("1") <= 3 for j, y in prints.items())]
    assert {r.doc_id for r in after} <= set(prints) and len(after) <= len(alone)
    assert all(any(bin(prints[i] ^ prints[r.doc_id]).count("1") <= 3 for r in after) or i not in alone for i in prints)

    before, after = kept["mixing sources to target weights"]
    total = sum(len(r[1].split()) for r in before)
    longest = {s: max(len(r[1].split()) for r in before if r[3] == s) for s in {r[3] for r in before}}
    assert abs(sum(len(r.text.split()) for r in after) - 1.5 * total) <= sum(1 + n / 2 for n in longest.values())
    assert {(r.doc_id, r.text) for r in after} <= {(r[0], r[1]) for r in before}
    assert max(Counter(r.doc_id for r in after).values()) <= 2

    before, after = kept["byte-level BPE encoding and decoding"]
    assert Counter(map(tuple, before)) == Counter(tuple(r[c] for c in columns) for r in after)
    assert all(bytes(r.decoded) == r.text.encode() and r.n_tokens == len(r.ids) // 4 for r in after)


def test_run_and_odd_documents(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, SF), "test-odd")
        assert docs.columns == odd.columns
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_stages_on_an_empty_table(spark, none):
    docs = none
    for _, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, SF), "test-none")
    assert docs.count() == 0


def test_every_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == sorted(range(1, len(numbers) + 1)) and set(queries.ORACLE_SQL) <= set(queries.QUERIES)

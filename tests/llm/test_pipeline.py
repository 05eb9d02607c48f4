from __future__ import annotations

import random

import corpus_pipeline as C
from sintonia.llm import budget_mix, quality
from tests.llm.test_budget_mix import check as check_mix
from tests.llm.test_exact_dedup import brute as equal_texts
from tests.llm.test_near_dedup import brute as near
from tests.llm.test_near_dedup import family, words
from tests.llm.test_packing import HOW, check as check_pack
from tests.llm.test_quality import brute as judged


def corpus():
    rng = random.Random(11)
    prose = lambda n: " ".join(words(rng, n))
    texts = [prose(rng.randint(60, 400)) for _ in range(60)]
    texts += [t for _ in range(5) for t in family(rng, words(rng, 150), 6, 3)]
    texts += texts[:10] + [t.replace(" ", "\n", 3) for t in texts[:5]]
    texts += [prose(10), "", None, "again and again " * 100]
    return [(k, t, f"s{k % 3}" if k % 2 else "hot") for k, t in enumerate(texts)]


def test_every_stage_works_on_all_its_predecessor_kept(spark, docs):
    rows = corpus()
    df = docs(rows)
    source = {r[0]: r[2] for r in rows}
    rows_of = lambda d: sorted((r.doc_id, r.text) for r in d.collect())
    stages = dict(C.STAGES)
    assert list(stages) == ["quality", "exact_dedup", "near_dedup", "mix", "pack"]

    good = stages["quality"](spark, df, "")
    kept = {r.doc_id for r in quality.judge(df).where("kept").collect()}
    assert {k for k, _ in rows_of(good)} == kept and not any(judged(t)[5] for _, t in rows_of(good))
    assert len(kept) == len(rows) - 4  # short, empty, null and repetitive go

    single = stages["exact_dedup"](spark, good, "")
    assert {k for k, _ in rows_of(single)} == {k for k, _ in equal_texts(rows_of(good)).values()}

    apart = stages["near_dedup"](spark, single, "")
    assert {k for k, _ in rows_of(apart)} == {d for d, _, c in near(rows_of(single), 80) if d == c}

    mixed = stages["mix"](spark, apart, "")
    check_mix([(k, t, source[k]) for k, t in rows_of(apart)], budget_mix.plan(apart).collect())
    assert all(d.columns == df.columns for d in (good, single, apart, mixed))

    packed = stages["pack"](spark, mixed.dropDuplicates(["doc_id"]), "")
    check_pack(packed.collect(), dict(rows_of(mixed)), HOW.capacity)


def test_empty_documents_stay_empty(spark, docs):
    d = docs([])
    for _, stage in C.STAGES:
        d = stage(spark, d, "")
    assert d.collect() == []


def test_run_packs_what_the_mix_takes(spark):
    out = C.run(spark, "/root/testdata/sf0.01")
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0

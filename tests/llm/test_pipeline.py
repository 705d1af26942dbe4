"""The pipeline against its operators one after the other, and its planted cases."""

import zlib
from collections import Counter

import corpus_pipeline
from loanlake.llm import decontaminate, line_dedup, packing, simhash, toxicity


def stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [docs]
    for number, (_, apply) in enumerate(corpus_pipeline.STAGES):
        apply(spark, kept[-1], folder).write.parquet(f"{tmp_path}/{number}")
        kept.append(spark.read.parquet(f"{tmp_path}/{number}"))
    return kept


def test_stages(spark, edge, docs, tmp_path):
    kept = stages(spark, edge, tmp_path)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "simhash near-dedup", "benchmark decontamination", "best-fit packing",
    ]
    assert all(frame.columns == kept[0].columns for frame in kept[:-1])
    source, clean, shorter, single, unleaked, packed = kept
    labels = spark.read.parquet(f"{edge}/labels.parquet")
    model = toxicity.fit(source, labels)
    want = Counter(r.doc_id for r in source.select("doc_id", "text").collect() if model.score(r.text or "") < 0.5)
    assert Counter(r.doc_id for r in clean.collect()) == want
    assert not any("idiot" in (r.text or "") for r in clean.collect())
    assert clean.count() > 0.7 * source.count()

    want = Counter((r.doc_id, r.text) for r in line_dedup.delete_repeats(clean).collect())
    rows = shorter.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == want
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)

    groups = simhash.near_duplicates(shorter).select("component_id", "root").distinct().collect()
    ids = [r.doc_id for r in single.collect()]
    assert Counter(ids) == Counter(r.component_id for r in groups)

    leaked = {r.doc_id for r in decontaminate.overlaps(single, spark.read.parquet(f"{edge}/benchmark.parquet")).collect()}
    assert leaked >= {111, 112, 116}
    assert Counter(r.doc_id for r in unleaked.collect()) == Counter(i for i in ids if i not in leaked)

    pieces = packed.collect()
    assert {r.doc_id for r in pieces} == set(ids) - leaked
    used = Counter()
    for r in pieces:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= packing.CAPACITY


def test_run_gives_the_last_stage(spark, edge, tmp_path):
    rows = Counter((r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, edge).collect())
    last = stages(spark, edge, tmp_path)[-1]
    assert rows == Counter((r.doc_id, r.piece, r.ids_crc32) for r in last.collect())


def test_nothing(spark, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_entry_lists_the_queries():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [f"op{n}_" for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)


def test_the_last_stage_keeps_the_ids(spark, edge, tmp_path):
    unleaked, packed = stages(spark, edge, tmp_path)[-2:]
    rows = packed.collect()
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in rows)
    want = packing.tokenised_pieces(unleaked).collect()
    assert Counter((r.doc_id, r.start, bytes(r.ids)) for r in rows) == Counter(
        (r.doc_id, r.start, bytes(r.ids)) for r in want
    )

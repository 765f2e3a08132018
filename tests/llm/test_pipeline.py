import numpy as np
import pandas as pd
from llm_docs import SF_SMALL, edge, make_docs, nothing  # noqa: F401
from test_packing import check as check_packing
from test_secret_scan import redacted
from test_simhash import classes, fingerprint

import corpus_pipeline
from tallyhouse.llm import langid, mixing
from tallyhouse.llm.common import read_table, stored
from tallyhouse.session import ensure_checkpoint_dir
from tallyhouse.sources import files


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_near_dedup", "secret_scans", "mixing", "best_fit_packing"]


def test_stages_against_brute_force(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    columns, rows = docs.columns, [tuple(r) for r in docs.collect()]
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stored(stage(spark, frames[-1], SF_SMALL), name))
    kept, single, clean, mixed, packed = ([tuple(r) for r in f.collect()] for f in frames[1:])
    for f in frames[1:5]:
        assert f.columns == columns
    # language: what the model accepts, nearly everything here
    model = langid.fit(docs)
    assert sorted(kept) == sorted(r for r in rows if langid.predict_text(r[1], model)[1] >= model.threshold)
    assert len(kept) >= 0.99 * len(rows)
    # near-duplicates: the smallest doc_id of each class
    label = classes([fingerprint(r[1]) for r in kept], 4)
    first = pd.Series([r[0] for r in kept]).groupby(label).min()
    assert sorted(r[0] for r in single) == sorted(first)
    # secrets: every row stays, spans are gone
    by_id = {r[0]: r for r in single}
    assert sorted(r[0] for r in clean) == sorted(by_id)
    for r in clean:
        text = redacted(by_id[r[0]][1])
        assert r == (r[0], text, *by_id[r[0]][2:4], len(text))
    # mixing: whole documents, as often as planned
    plan = {r.doc_id: r.copies for r in mixing.mix_plan(frames[3]).collect()}
    assert sorted(mixed) == sorted(r for r in clean for _ in range(plan[r[0]]))
    # packing: every copy of every document, whole and gapless
    texts = {}
    for r in mixed:
        texts.setdefault(r[0], []).append(r[1])
    check_packing(frames[5].collect(), texts, slack=2)


def test_run(spark):
    folder = ensure_checkpoint_dir(spark)
    before = set(files.children(spark, folder))
    run = corpus_pipeline.run(spark, SF_SMALL)
    left = [n for n in files.children(spark, folder) if n not in before and n.startswith("tallyhouse-")]
    assert len(left) == 1 and left[0].startswith("tallyhouse-best_fit_packing")      # nothing but the result
    assert run.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert run.count() > 100


def test_edge_rows_pass_every_stage(spark, edge, nothing):  # noqa: F811
    for docs in (edge, nothing):
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF_SMALL), name)
        assert docs.count() >= 0

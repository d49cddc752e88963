"""The corpus pipeline against a plain version of its four stages, and the registry."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from layerforge.llm import crf_quality
from layerforge.session import scratch_dir, ship_package
from test_operators import WORD, _brute_groups, _brute_repeats, _crc, _fingerprint, _ids, _words


def _tables(spark, rng):
    rows, labels = [], []
    passage = _words(rng, 130)
    for i in range(160):
        junk = i % 8 == 7
        lines = [" ".join(w + "%%%" for w in _words(rng, 15).split()) if junk else _words(rng, 15) + "." for _ in range(rng.randint(1, 6))]
        rows.append((i, "\n".join(lines) + (f"\n{passage}" if i % 10 == 0 else ""), "en", f"src{i % 3}", 0))
        labels.append((i, int(not junk), 0))
    rows += [(200, rows[0][1], "en", "a", 0), (201, rows[1][1] + " end", "fr", None, None), (202, None, None, None, None),
             (203, "", "en", "a", 0), (203, "", "en", "a", 0), (None, rows[2][1], "en", "a", 0)]
    base = scratch_dir(spark, "corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return base, rows


def test_pipeline_equals_the_plain_version(spark):
    ship_package(spark)
    base, rows = _tables(spark, random.Random(11))
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    field = crf_quality.train(docs, labels)
    good = [r for r in rows if crf_quality.scores([r[1] or ""], field)[0] >= 0.3]
    assert 130 < len(good) < len(rows)  # junk goes, clean documents stay
    marks = [_fingerprint(r[1]) for r in good]
    root, best = _brute_groups(marks), {}
    for r, m in zip(good, marks):
        key = (r[0] is None, r[0] or 0)
        best.setdefault(root[m], (key, r))
        best[root[m]] = min(best[root[m]], (key, r), key=lambda x: x[0])
    kept = [r for _, r in best.values()]
    cut = _brute_repeats([(r[1] or "").encode() for r in kept], corpus_pipeline.PASSAGE)
    wanted = {r[0]: _ids(WORD, text.decode("utf-8", "ignore")) + [1] for r, (_, _, _, text) in zip(kept, cut)}
    pieces = defaultdict(list)
    for p in corpus_pipeline.run(spark, base).collect():
        pieces[p.doc_id].append(p)
    assert set(pieces) == set(wanted)
    for doc, ids in wanted.items():
        at = 0
        for p in sorted(pieces[doc], key=lambda p: p.start):
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), _crc(ids[at:at + p.length]))
            at += p.length
        assert at == len(ids)


def test_filter_stages_keep_the_columns(spark):
    base, rows = _tables(spark, random.Random(12))
    docs = spark.read.parquet(f"{base}/documents.parquet").withColumn("extra", F.lit(1))
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, base)
        assert out.schema == docs.schema, name
        assert step(spark, docs.limit(0), base).collect() == [], name


def test_every_operator_is_registered():
    names = list(E.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "simhash_near_dedup", "suffix_array_dedup", "packing"]

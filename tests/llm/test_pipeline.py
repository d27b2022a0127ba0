"""Every stage on its own input, against the rule it applies."""

import zlib

import numpy as np
import pytest

import corpus_pipeline as P
from daystream.llm import mix, near_dup, pack, quality
from test_near_dup import slow as slow_components
from test_suffix_dedup import slow as slow_strings

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (_, f) in enumerate(P.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        f(spark, docs, SF).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_columns(results):
    for before, after in results[:-1]:
        assert after.dtypes == results[0][0].dtypes


def test_quality(spark, results):
    before, after = results[0]
    kept = {r.doc_id for r in quality.quality(before, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r.kept}
    assert rows(after) == [r for r in rows(before) if r[0] in kept] and kept


def test_near_duplicates(results):
    before, after = results[1]
    comp = slow_components([(r.doc_id, r.text) for r in before.collect()])
    assert rows(after) == [r for r in rows(before) if comp[r[0]] == r[0]]


def test_strings(results):
    import hashlib
    before, after = results[2]
    want = {d: s for d, *_, s in slow_strings([(r.doc_id, r.text) for r in before.collect()])}
    rest = {r.doc_id: (r.lang, r.source) for r in before.collect()}
    assert after.count() == len(want)
    for r in after.collect():
        assert (r.lang, r.source) == rest[r.doc_id] and r.n_chars == len(r.text)
        # bytes cut inside a character are the only difference
        assert hashlib.sha256(r.text.encode()).hexdigest() == want[r.doc_id] or not r.text.isascii()


def test_mix(results):
    before, after = results[3]
    want = sorted(tuple(r.row) for r in mix.systematic_mix(before).collect() for _ in range(r.copies))
    assert sorted(map(tuple, after.collect())) == want


def test_packing(results):
    before, after = results[4]
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(pack.tokenizer_path())
    want = sorted(tok.encode(r.text or "", add_special_tokens=False).ids + [0] for r in before.collect())
    got, at = [], 0
    for r in sorted(after.collect(), key=lambda r: (r.sequence_id, r.offset)):
        assert r.sequence_id * 1024 + r.offset == at and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        at += r.length
        if r.start == 0:
            got.append([])
        got[-1] += np.frombuffer(bytes(r.ids), "<u4").tolist()
    assert sorted(got) == want


def test_run_is_the_stages(spark, results):
    assert P.run(spark, SF).count() == results[-1][1].count()


def test_repeated_and_null_rows(spark, docs):
    d = docs([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, None), (None, "a b c d e f g"), (3, "")])
    out = P.keep_one_of_near_duplicates(spark, d, SF)
    assert out.columns == d.columns and sorted(str(r.doc_id) for r in out.collect()) == ["1", "2", "3"]
    assert near_dup.near_duplicates(d).count() == 5
    cut = P.cut_repeated_strings(spark, d, SF)
    assert cut.columns == d.columns and cut.count() == 5

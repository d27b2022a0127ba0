import random
import re
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from daystream.llm import mix, pack


def slow_targets(sizes):
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - 3 * sum(sizes[s] for s in capped)
        free = sum(weight[s] for s in sizes if s not in capped)
        t = {s: 3 * sizes[s] if s in capped else left * weight[s] / free for s in sizes}
        over = {s for s in sizes if t[s] > 3 * sizes[s]} - capped
        if not over:
            return t
        capped |= over


def test_mix_targets_and_copies(spark):
    rng = random.Random(1)
    rows = [(i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.randint(0, 60))), rng.choice(["a"] * 12 + ["b", "é", "Z", None, ""])) for i in range(4000)]
    rows += [(9, "same row", "a")] * 2 + [(None, "x y", None), (10, None, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash")).withColumn("k", F.lit(0))
    out = mix.systematic_mix(df, bucket_rows=64).collect()
    assert len(out) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in out:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r.row.text or "")) and 0 <= r.taken <= 3 * r["size"]
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
    want = slow_targets(sizes)
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 200 + 0.02 * want[s]
    again = mix.systematic_mix(df.repartition(7), bucket_rows=64)
    key = lambda rs: sorted((str(r.doc_id), str(r.source), r.taken) for r in rs)
    assert key(again.collect()) == key(out)
    assert mix.systematic_mix(df.limit(0)).count() == 0


def test_pack_round_trip(spark):
    rng = random.Random(4)
    texts = ["", None, "one", "a  b\n\nc \t d", "\0 nul", "<|endoftext|> x", " lead", "trail \n", "x" * 5000,
             "déjà vu\nñandú 漢字 🙂", " ".join(rng.choice(["the", "cat.", "Über", "x1"]) for _ in range(3000))]
    texts += [" ".join(rng.choice(["aa", "bb\ncc", "d"]) for _ in range(rng.randint(0, 400))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "again"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash")).repartition(3)
    out = pack.pack(df, pack.tokenizer_path(), length=64).collect()
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(pack.tokenizer_path())
    tok.encode_special_tokens = True
    seq = defaultdict(list)
    for r in out:
        seq[r.sequence_id].append(r)
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32
    total = 0
    for s in range(max(seq) + 1):
        at = 0
        for r in sorted(seq[s], key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        total += at
        assert at == 64 or s == max(seq)
    want = sorted([tok.encode(t or "", add_special_tokens=False).ids + [0] for _, t in rows])
    # a document's pieces follow one another from start 0
    got, flat = [], sorted(out, key=lambda r: (r.sequence_id, r.offset))
    for r in flat:
        if r.start == 0:
            got.append([])
        assert r.start == len(got[-1])
        got[-1] += np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert r.doc_tokens >= len(got[-1])
    assert sorted(got) == want and total == sum(map(len, want))
    assert pack.pack(df.limit(0), pack.tokenizer_path()).count() == 0


def test_cached_pieces_equal_whole_texts(spark):
    from tokenizers import Tokenizer
    d = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    enc = pack.Encoder(pack.tokenizer_path())
    tok = Tokenizer.from_file(pack.tokenizer_path())
    assert [np.frombuffer(x, "<u2").tolist() for x in enc(d)] == [e.ids for e in tok.encode_batch(d, add_special_tokens=False)]


def test_special_token_strings_are_those_of_an_unmodified_tokenizer():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(pack.tokenizer_path())
    d = ["<|endoftext|>", "a <|endoftext|> b", "x\n\n<|endoftext|>y<|endoftext|>", "<|endoftext", "plain text", ""]
    got = [np.frombuffer(x, "<u2").tolist() for x in pack.Encoder(pack.tokenizer_path(), special_tokens=True)(d)]
    assert got == [tok.encode(t, add_special_tokens=False).ids for t in d] and got[0] == [50256]


def test_encoder_keeps_little_in_a_worker():
    from daystream.llm import pack
    enc = pack.Encoder(pack.tokenizer_path(), most=10, special_tokens=True)
    plain = [" ".join(f"word{i}" for i in range(50)), "", "a  b\n\nc"]
    got = enc(plain)
    assert "tok" not in vars(enc)  # no second tokenizer in memory until a text needs it
    assert len(enc.known) > 10 and enc(["word1"]) and len(enc.known) <= 3
    own = enc.tok.encode_batch(plain, add_special_tokens=False)
    assert [np.frombuffer(x, enc.dtype).tolist() for x in got] == [e.ids for e in own]
    assert np.frombuffer(enc(["a<|endoftext|>b"])[0], enc.dtype).tolist() == enc.tok.encode("a<|endoftext|>b", add_special_tokens=False).ids

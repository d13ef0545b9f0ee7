"""The pipeline against plain versions of its stages, and the way it is registered."""

import hashlib
import subprocess
import sys
from pathlib import Path

import public_tokenizers
import tiktoken
from fixtures import documents, sentence, texts
from test_corpus_operators import plain_classes

import __spark_entry__ as contract
import corpus_pipeline
from tablesync.llm.bpe import read_ranks

ROOT = Path(__file__).resolve().parent.parent.parent


def test_stages_keep_the_columns_and_do_their_work(spark, tmp_path):
    import random

    item = sentence(random.Random(11), "en", 40)
    live, shared = "0123456789abcdef" * 2, "fedcba9876543210" * 2
    filler = [sentence(random.Random(n), "en", 50) for n in range(12)]
    rows = [r for r in texts() if r[0] not in (108, 109, 112, 113, 115)] + [  # those left out hold secrets of their own
        (700, filler[0] + " " + item + " " + filler[1], "en", "s0"),
        (701, filler[2] + " key " + live, "en", "s1"),
        *[(702 + n, filler[3 + n] + " key " + shared, "en", f"p{n}") for n in range(8)],  # widely copied
    ]
    docs = documents(spark, rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, str(tmp_path))
        assert table.columns == docs.columns
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    worded = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    classes = plain_classes(worded)
    want = {}
    for i, text, _, _ in worded:
        if i is None or classes[i] == i:
            want[i] = library.encode_ordinary(text.replace(live, "[SECRET]"))
    del want[700]
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {i: list(r["ids"]) for i, r in got.items()} == want
    assert all(r["ids_sha256"] == hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest() for r in got.values())


def test_registered_names():
    names = contract.queries()
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "decontamination", "secret_scan", "tokens"]


def test_the_rest_imports_without_this_part():
    code = "import sys; sys.modules['tablesync.llm'] = None; import __spark_entry__ as e; assert len(e.queries()) > 50; assert not any(n.startswith('op1_') or n == 'pipeline' for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)

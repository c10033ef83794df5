"""The registered SQL twins, and each pipeline stage against brute force on its own input."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from aqlake.llm import simhash
from aqlake.llm.quality import quality_digest
from aqlake.llm.sql import ORACLE
from checks.compare import same_rows, sql_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE)
def test_same_as_sql(spark, name):
    df = driver.queries()[name](spark, SF)
    assert same_rows(df.columns, [tuple(r) for r in df.collect()], *sql_rows(ORACLE[name], SF)) == ""


def test_all_are_registered():
    names = driver.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns, states = docs.columns, [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, states[-1], SF)
        made.write.parquet(path := f"{tmp_path}/{number}")
        states.append(spark.read.parquet(path))
    assert all(s.columns == columns for s in states[:-1])
    rows = [{r.doc_id: r.text for r in s.select("doc_id", "text").collect()} for s in states[:-1]]
    assert set(rows[1]) == {r.doc_id for r in quality_digest(docs, labels).where("predicted = 1").collect()}

    held = {}
    for i, text in rows[1].items():
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                held.setdefault(key(line), set()).add(i)
    drop = {k: max(v) for k, v in held.items() if len(v) >= 3}
    assert rows[2] == {
        i: "\n".join(x for x in (t or "").split("\n") if drop.get(key(x), i) == i) for i, t in rows[1].items()
    }

    fps = {i: simhash.fingerprint(t) for i, t in rows[2].items()}
    root = {i: i for i in fps}
    for _ in fps:
        new = {i: min(root[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 2) for i in fps}
        if new == root:
            break
        root = new
    assert set(rows[3]) == {i for i in fps if root[i] == i}

    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r.text)
        n = min(13, len(w))
        windows |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
    clean = set()
    for i, text in rows[3].items():
        w, hit = words(text), set()
        for n in {len(x) for x in windows}:
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) in windows:
                    hit |= set(range(at, at + n))
        if not hit or 20 * len(hit) < len(w):
            clean.add(i)
    assert set(rows[4]) == clean
    packed = states[5].toPandas()
    assert set(packed.doc_id) == clean and packed.groupby("sequence_id").length.sum().max() <= 2048


def test_run_gives_the_stages_rows(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(got.columns)


def test_stages_judge_rows_where_ids_are_null_or_repeat(spark, tmp_path):
    passage = " ".join(f"word{i}" for i in range(40))
    plain = [" ".join(f"{w}{i}" for i in range(60)) for w in ("river", "hill", "stone", "mill")]
    spark.createDataFrame([("b", passage)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    make = lambda rows: spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], kind).repartition(3)
    read = lambda df: sorted([(r.doc_id, r.text) for r in df.collect()], key=str)

    docs = make([(None, plain[0]), (None, passage), (1, plain[1]), (1, passage), (2, passage), (3, None), (4, plain[2]), (4, plain[2])])
    wanted = [(None, plain[0]), (1, plain[1]), (3, None), (4, plain[2]), (4, plain[2])]
    assert read(corpus_pipeline.benchmark(spark, docs, str(tmp_path))) == sorted(wanted, key=str)

    # 5 stays for its second text, and is a copy of 2 with its first; nulls group like other rows
    docs = make([
        (2, plain[0]), (5, plain[0]), (5, plain[1]), (7, plain[2]), (7, plain[2]), (7, plain[2]), (None, plain[2]), (None, plain[0]),
        (None, plain[3]), (None, plain[3]),
    ])
    wanted = [(2, plain[0]), (5, plain[1]), (7, plain[2]), (None, plain[3])]
    assert read(corpus_pipeline.near_dedup(spark, docs, "")) == sorted(wanted, key=str)

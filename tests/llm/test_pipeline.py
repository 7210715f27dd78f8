from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from callgrain.llm import queries as q

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage read and gave, as lists of rows."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, step in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        step(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_order_and_columns(steps):
    assert [name for name, _, _ in steps] == ["toxicity", "minhash near dedup", "benchmark decontamination", "secret scan", "bpe"]
    first = steps[0][1]
    assert all(after.columns == first.columns for _, _, after in steps[:-1])


def test_toxic_documents_go(spark, steps):
    _, before, after = steps[0]
    predicted = {r.doc_id for r in q.op2_toxicity(spark, SF).collect() if r.predicted}
    assert predicted and set(rows(before)) - set(rows(after)) == predicted


def test_one_of_each_group_stays(steps):
    from .test_near_text import brute_force

    _, before, after = steps[1]
    kept = {k for k, v in brute_force([(r.doc_id, r.text) for r in before.collect()]).items() if v[2]}
    assert set(rows(after)) == kept and len(kept) < before.count()


def test_leaks_go(spark, steps):
    _, before, after = steps[2]
    norm = lambda t: " ".join(re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", t.lower()))
    items = [norm(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holds = {r.doc_id for r in before.collect() if any(f" {item} " in f" {norm(r.text)} " for item in items)}
    gone = set(rows(before)) - set(rows(after))
    assert holds and gone == holds


def test_secrets_are_redacted_and_nothing_else(steps):
    _, before, after = steps[3]
    old, new = rows(before), rows(after)
    assert set(old) == set(new)
    pattern = re.compile(r'(?<=token = ")[0-9a-f]{40}(?=")', re.I)
    changed = 0
    for k in old:
        expected = pattern.sub("[SECRET]", old[k].text) if pattern.search(old[k].text) else old[k].text
        expected = re.sub(r'(?<=TOKEN = ")[0-9A-F]{40}(?=")', "[SECRET]", expected)
        assert new[k].text == expected
        assert new[k].n_chars == (len(expected) if expected != old[k].text else old[k].n_chars)
        changed += expected != old[k].text
    assert changed


def test_tokens_are_the_library_s(steps):
    tokenizers = pytest.importorskip("tokenizers")
    _, before, after = steps[4]
    library = tokenizers.Tokenizer.from_file(q.vocabulary("word_bpe_49k.json"))
    old, new = rows(before), rows(after)
    assert set(old) == set(new)
    for k in list(old)[:200]:
        expected = library.encode(old[k].text, add_special_tokens=False).ids
        assert new[k].token_ids == expected and new[k].decoded == library.decode(expected, skip_special_tokens=False)


def test_stages_take_strange_rows_and_empty_tables(spark, strange, documents):
    for name, step in corpus_pipeline.STAGES:
        for docs in (strange.select("doc_id", "text", "lang", "source", "n_chars"), strange, documents([])):
            out = step(spark, docs, "/root/testdata/sf0.001")
            assert set(docs.columns) <= set(out.columns), name
            assert out.count() <= docs.count()


def test_redaction_keeps_a_users_columns(spark, documents):
    secret = "0123456789abcdef0123456789abcdef01234567"
    made = documents([(k, f'{w} token = "{secret[k % 7:] + secret[:k % 7]}" and') for k, w in enumerate(["a", "b"] * 20)]
                     + [(k + 50, f"commit {secret[k % 9:] + secret[:k % 9]} by them") for k in range(40)])
    docs = made.withColumns({"_before": F.lit("mine"), "doc": F.lit("too"), "clean": F.lit("as well")})
    out = {r.doc_id: r for r in corpus_pipeline.redact_secrets(spark, docs, SF).collect()}
    assert all((r["_before"], r["doc"], r["clean"]) == ("mine", "too", "as well") for r in out.values())
    assert out[0].text == 'a token = "[SECRET]" and' and out[0].n_chars == len(out[0].text)
    assert out[50].text == f"commit {secret} by them"


def test_registered(spark):
    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 14)} == {re.match(r"op\d+", k)[0] for k in names if re.match(r"op\d+_", k)}
    assert names["pipeline"] is corpus_pipeline.run and set(__spark_entry__.oracle_sql()) <= set(names)

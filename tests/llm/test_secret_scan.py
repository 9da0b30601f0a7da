from __future__ import annotations

import hashlib
import re

from tidemark.llm.secret_scan import find_secrets, redact_secrets

KEY = "AKIA" + "ABCDEFGH12345678"
LIVE = "9f8e7d6c5b4a39281706f5e4d3c2b1a0"


def plain(text):
    """The base spans straight from the patterns."""
    assign = r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [("assign", m) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    found += [("access", m) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    kinds = ["assign", "access", "hex"]
    spans = sorted(((m.start(), kinds.index(k), m.end()) for k, m in found))
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)


def rows(spark):
    texts = [f'é Token = "{LIVE}" x', f"PASSWORD:short secret=key {KEY} and {KEY}", "api_key=abc", f"passwd={LIVE}9"]
    data = [(i, t, "me") for i, t in enumerate(texts)]
    # an example that many owners hold
    data += [(10 + i, "token: EXAMPLEKEY123", f"owner{i}") for i in range(4)]
    return spark.createDataFrame(data, "doc_id long, text string, source string")


def test_base_spans_and_verdicts(spark):
    docs = rows(spark)
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in find_secrets(docs).collect():
        want = plain(text[r["doc_id"]])
        assert r["spans"] == want
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert (r["n_copied"] > 0) == (r["doc_id"] >= 10)


def test_rare_runs_of_one_owner(spark):
    run = "Zk3+pQ9xVb7LmT2wRs8YdH5j"
    docs = spark.createDataFrame(
        [(1, f"see {run} here", "a"), *[(i, "see Qw3+pQ9xVb7LmT2wRs8YdH5j here", f"o{i}") for i in range(2, 7)]],
        "doc_id long, text string, source string",
    )
    found = {r["doc_id"]: r["spans"] for r in find_secrets(docs).collect()}
    assert found[1] == f"rare:4:{4 + len(run)}" and found[3] == ""


def test_redaction_takes_effect(spark):
    found = {r["doc_id"]: r["text"] for r in redact_secrets(rows(spark)).collect()}
    assert found[0] == 'é [SECRET]" x'
    assert found[1] == "PASSWORD:short secret=key [SECRET] and [SECRET]"
    assert found[2] == "api_key=abc"
    assert found[10] == "token: EXAMPLEKEY123"


def test_odd_rows(odd_rows, no_rows):
    assert find_secrets(odd_rows).count() == odd_rows.count()
    clean = redact_secrets(odd_rows)
    assert clean.columns == odd_rows.columns
    assert sorted(map(str, clean.collect())) == sorted(map(str, odd_rows.collect()))
    assert find_secrets(no_rows).count() == redact_secrets(no_rows).count() == 0


def test_all_documents_against_patterns(documents):
    text = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    for r in find_secrets(documents).collect():
        base = ",".join(s for s in r["spans"].split(",") if not s.startswith("rare"))
        assert base == plain(text[r["doc_id"]])

"""Registered queries of the subpackage: SQL where there is any, brute force elsewhere, on whole small tables."""

import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from check import compare, connect  # noqa: E402
from lockweir.llm import queries  # noqa: E402
from lockweir.llm.settings import byte_tokenizer, piece_model  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows(spark, key):
    return queries.QUERIES[key](spark, SF).collect()


@pytest.mark.parametrize("key", list(queries.ORACLES))
def test_sql(spark, key):
    problem, n = compare(spark, connect(SF), key, queries.QUERIES[key], queries.ORACLES[key], SF)
    assert problem is None and n


def test_op1(spark, documents):
    import re

    out = rows(spark, "op1_pii_surrogates")
    assert len(out) == len(documents)
    form = r"[\w.]+@[\w.]+|\b\d{16}\b|\b[0-9a-fA-F]{40}\b|\d+\.\d+\.\d+\.\d+|\+1 \(\d+\) [\d-]+"
    seen, stand_in = set(), {}
    for r in out:
        found = re.findall(form, documents[r.doc_id])
        if not r.n_entities:
            assert r.text == documents[r.doc_id] and not found
        else:
            new = re.findall(form, r.text)
            assert len(new) == len(found) and not set(found) & set(new)
            for a, b in zip(found, new):
                assert stand_in.setdefault(a.lower(), b.lower()) == b.lower()
            seen.update(found)
    assert seen and len(set(stand_in.values())) == len(stand_in)


def test_op3(spark, documents):
    from tokenizers import Tokenizer

    encode, at = Tokenizer.from_file(byte_tokenizer()).encode, 0
    out = {r.doc_id: r for r in rows(spark, "op3_binary_records")}
    assert len(out) == len(documents)
    for d in sorted(documents):
        ids = np.array([*encode(documents[d] or "", add_special_tokens=False).ids, 0], "<u4")
        assert (out[d].start, out[d].n_tokens, out[d].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_op4(spark, documents):
    import re

    lines = {
        "MIT line": "released under the mit license",
        "Apache-2.0 line": "licensed under the apache license version 2 0",
        "GPL-3.0 line": "this work is licensed under the gnu general public license version 3",
        "CC-BY-NC-4.0 line": "licensed under cc by nc 4 0",
    }
    want = sorted(
        (d, name)
        for d, text in documents.items()
        for name, line in lines.items()
        for _ in re.findall(line, re.sub(r"[\W_]+", " ", text.lower()))
    )
    out = rows(spark, "op4_patience_licenses")
    assert sorted((r.doc_id, r.license) for r in out) == want and want
    assert all(r.coverage == 1 for r in out)


def test_op6_and_op8_hold_out(spark):
    labels = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    for key, label, fold, least in (("op6_fourier_quality", "quality", (5, 0), 0.97), ("op8_noisy_or_toxicity", "toxic", (3, 1), 0.95)):
        out = queries.QUERIES[key](spark, "/root/testdata/sf0.1").collect()
        assert all(0 <= r.score <= 1 for r in out)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % fold[0] == fold[1]) for r in out)
        held = [r for r in out if r.held_out and r.doc_id in labels]
        right = sum(r.predicted == labels[r.doc_id][label] for r in held)
        assert right >= least * len(held)


def test_op7(spark, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    out = rows(spark, "op7_template_decontamination")
    assert {(r.doc_id, r.item_id) for r in out} == brute.leaks(documents.items(), items)


def test_op9(spark, documents):
    from sentencepiece import SentencePieceProcessor

    encode = SentencePieceProcessor(model_file=piece_model()).encode
    out = rows(spark, "op9_piece_lattice")
    assert len(out) == len(documents)
    assert all(r.ids == encode(documents[r.doc_id]) and r.round_trip for r in out)


def test_op10(spark, documents):
    fps = {d: brute.simhash(t) for d, t in documents.items()}
    roots = brute.components(fps)
    out = rows(spark, "op10_simhash_variants")
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in out} == {(d, f"{fps[d]:016x}", roots[d]) for d in fps}


def test_pipeline(spark, documents):
    import corpus_pipeline
    from lockweir.session import cut

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = cut(stage(spark, docs, SF))
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name != "sentencepiece":
            assert docs.columns == columns
            kept[name] = {d: r.text for d, r in after.items()}
        if name == "simhash_near_dedup":
            roots = brute.near_copies(before)
            assert set(after) == {d for d in before if roots[d] == d}
        if name == "benchmark_decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert set(after) == set(before) - {d for d, _ in brute.leaks(before.items(), items)}
    assert all(r.decoded == kept["pii_surrogates"][d] for d, r in after.items())
    assert {(r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, SF).collect()} == {
        (d, tuple(r.ids)) for d, r in after.items()
    }

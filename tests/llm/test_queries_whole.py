"""Registered queries on a given table, each row against a plain version of its contract."""

import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from test_rules_and_mixing import brute_measures, brute_targets
from tokenizers import Tokenizer

from mapstrata.llm import quality_classifier, rules
from mapstrata.llm.mixing import WEIGHTS
from mapstrata.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def test_quality_rules(spark, docs):
    found = QUERIES["op9_quality_rules"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in found) == sorted(docs)
    for r in found:
        m = dict(zip(rules.MEASURES, brute_measures(docs[r.doc_id].text)))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == tuple(m[c] for c in rules.MEASURES[:5])
        failed = {rule.name for rule in rules.RULES if eval(rule.fails.replace(" = ", " == "), {}, m)}
        assert r.base_failed == (m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"])
        assert r.kept == (not failed) and r.failed_bits == sum(1 << rule.bit for rule in rules.RULES if rule.name in failed)


def test_source_mix(spark, docs):
    found = QUERIES["op4_source_mix"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in found) == sorted(docs)
    size = {i: len((d.text or "").encode().split()) for i, d in docs.items()}
    sizes, taken = collections.Counter(), collections.Counter()
    for i, d in docs.items():
        sizes[d.source] += size[i]
    wanted = brute_targets(sizes, WEIGHTS)
    assert sum(wanted.values()) == pytest.approx(sum(sizes.values()))
    epochs = collections.defaultdict(set)
    for r in found:
        source = docs[r.doc_id].source
        assert (r["size"], r.source_size) == (size[r.doc_id], sizes[source]) and r.target == pytest.approx(wanted[source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[source] += r.taken
        if r["size"]:
            epochs[source].add(r.taken // r["size"])
    for source, target in wanted.items():
        assert taken[source] == round(target)
        assert max(epochs[source]) - min(epochs[source]) <= 1  # every document whole before any comes again
    again = QUERIES["op4_source_mix"](spark, SF_DIR).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))


def test_packing_every_piece(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array(library.encode(d.text or "", add_special_tokens=False).ids + [1], "<u4") for i, d in docs.items()}
    found = QUERIES["op7_harmonic_packing"](spark, SF_DIR).collect()
    covered, held = collections.defaultdict(list), collections.defaultdict(list)
    for r in found:
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        covered[r.doc_id].append((r.start, r.length))
        held[r.sequence_id].append((r.offset, r.length))
    assert covered.keys() == docs.keys()
    for spans, total in [*((covered[i], len(ids[i])) for i in docs), *((s, None) for s in held.values())]:
        at = 0
        for start, length in sorted(spans):
            assert start == at and length > 0
            at += length
        assert at == total if total is not None else at <= 2048


def test_classifier_solves_its_equations(spark, docs):
    """Scores from features of all labelled rows at once, equations solved directly, and calibration by plain pooling."""
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    stats = {i: np.array(quality_classifier.statistics((d.text or "").encode())) for i, d in docs.items()}
    held_out = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in docs}
    learned = [i for i in docs if labels.get(i) in (0, 1) and not held_out[i]]
    x, y = np.array([stats[i] for i in learned]), np.array([labels[i] for i in learned], float)
    model = quality_classifier.Model(x.mean(axis=0), np.sqrt(np.maximum(x.var(axis=0), 1e-4)))
    cosines = np.cos(np.clip((x - model.mean) / model.scale, -4, 4) @ model.w + model.phase)
    features = np.column_stack([cosines, np.ones(len(x))])
    penalty = np.sqrt(np.append(np.full(cosines.shape[1], quality_classifier.RIDGE), 1e-9))
    weights = np.linalg.lstsq(np.vstack([features, np.diag(penalty)]), np.append(y, np.zeros(len(penalty))), rcond=None)[0]
    raw = features @ weights
    bins = np.clip(np.floor((raw + 1) / 3 * quality_classifier.BINS), 0, quality_classifier.BINS - 1).astype(int)
    edges = np.unique(bins)
    n = np.array([(bins == b).sum() for b in edges], float)
    levels = np.array([y[bins == b].mean() for b in edges])
    while (np.diff(levels) < -1e-12).any():  # pool neighbours that fall, one pair at a time
        at = int(np.argmax(np.diff(levels) < -1e-12))
        same = (levels == levels[at]) | (levels == levels[at + 1])
        levels[same] = np.average(levels[same], weights=n[same])
    places = (edges + 0.5) / quality_classifier.BINS * 3 - 1
    found = {r.doc_id: r for r in QUERIES["op2_quality_classifier"](spark, SF_DIR).collect()}
    assert found.keys() == docs.keys()
    assert all(r.held_out == held_out[i] and r.predicted == int(r.score >= 0.3) for i, r in found.items())
    every = np.array([stats[i] for i in docs])
    direct = np.column_stack([np.cos(np.clip((every - model.mean) / model.scale, -4, 4) @ model.w + model.phase), np.ones(len(every))]) @ weights
    expected = np.interp(direct, places, levels)
    # features are rounded to whole numbers of a fine grain, and a bin's border may lie between both versions of a row
    scores = np.array([found[i].score for i in docs])
    assert np.median(np.abs(scores - expected)) < 0.01 and np.mean(np.abs(scores - expected) > 0.05) < 0.02

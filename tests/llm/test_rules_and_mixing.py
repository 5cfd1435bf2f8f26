"""Quality ledger and source mixing against brute force."""

import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mapstrata.llm import rules
from mapstrata.llm.mixing import allocated, mix_documents, mix_plan, sized

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), len(lines), text.count("!"))


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(list("ab \n\té漢#|! ")), max_size=80))
def test_measures(text):
    assert rules.measure(text.encode()) == brute_measures(text)


ROWS = [(1, None, "a"), (2, "", "a"), (3, "w " * 60, None), (4, " ".join(f"w{i}" for i in range(80)), "b"), (4, "#|% " * 70, "b")]
ROWS += [(5, " ".join(f"long{i}" for i in range(200_000)), "b"), (None, "a b c\na b c\n \n\n a b c", "c")]


def test_ledger(spark, documents):
    ledger = rules.quality_ledger(documents(ROWS), ["doc_id", "size"])
    found = sorted((tuple(r[m] for m in rules.MEASURES), r.doc_id, r["size"]) for r in ledger.where("doc_id is not null").collect())
    assert found == sorted((brute_measures(t), i, "x") for i, t, _ in ROWS if i is not None)
    assert rules.quality_ledger(documents(ROWS).where("false"), ["doc_id"]).count() == 0


def test_policies_and_ablations(spark, documents):
    ledger = rules.quality_ledger(documents(ROWS), ["doc_id"])
    rows = ledger.collect()
    for policy in (rules.BASE_POLICY, rules.POLICY):
        found = {r.rule: (r.n_failed, r.n_only) for r in rules.ablations(ledger, policy).collect()}
        for name in policy.rules:
            bit = 1 << next(r.bit for r in rules.RULES if r.name == name)
            own = [r.failed_bits & policy.mask for r in rows]
            assert found[name] == (sum(b & bit > 0 for b in own), sum(b == bit for b in own))


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = sum(sizes.values()), set(sizes), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not over:
            out |= {s: left * weight[s] / total for s in open_}
            break
        out |= {s: most * sizes[s] for s in over}
        left -= sum(most * sizes[s] for s in over)
        open_ -= over
    return out


@pytest.mark.parametrize("seed", range(4))
def test_mix(spark, documents, seed):
    import random

    draw = random.Random(seed)
    names = [None, "z", "a", "é", "B", "漢"][: 2 + seed]
    rows = [(draw.choice([i, i, 7]), " ".join(["w"] * draw.choice([0, 1, 5, 40])), names[0] if draw.random() < 0.5 else draw.choice(names)) for i in range(300)]
    rows += [(900, None, None), (901, "w " * 5000, "z")]
    docs = documents(rows)
    found = allocated(rows_ := sized(docs), mix_plan(rows_)).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    wanted, taken = brute_targets(sizes), defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(wanted[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    tied = sum(n for n in Counter(i for i, *_ in rows).values() if n > 1)
    for source in sizes:
        assert abs(taken[source] - wanted[source]) <= 1 + tied
    again = allocated(rows_ := sized(documents(rows, 5)), mix_plan(rows_)).collect()
    assert sorted((str(r.doc_id), r["size"], r.taken) for r in found) == sorted((str(r.doc_id), r["size"], r.taken) for r in again)
    mixed = mix_documents(docs)
    assert mixed.columns == docs.columns
    words = defaultdict(int)
    for r in mixed.collect():
        words[r.source] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert {s: n for s, n in words.items() if n} == {s: n for s, n in taken.items() if n}


def test_empty_and_wordless(spark, documents):
    none = documents([(1, "x", "a")]).where("false")
    rows = sized(none)
    assert allocated(rows, mix_plan(rows)).count() == 0 and mix_documents(none).count() == 0
    blank = sized(documents([(1, "", "a"), (2, None, "b")]))
    assert {(r.target, r.taken) for r in allocated(blank, mix_plan(blank)).collect()} == {(0.0, 0)}

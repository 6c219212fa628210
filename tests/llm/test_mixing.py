import itertools
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm.mixing import fit, knapsack, mix, mix_stage


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 12), st.integers(1, 4)), min_size=1, max_size=4, unique_by=lambda x: x[0]), st.integers(0, 60))
def test_knapsack_is_as_good_as_trying_all(items, budget):
    lengths, counts = zip(*items, strict=True)
    take = knapsack(list(lengths), list(counts), budget)
    sums = {sum(a * b for a, b in zip(xs, lengths, strict=True)) for xs in itertools.product(*[range(c + 1) for c in counts])}
    best = min(sums, key=lambda s: (abs(s - budget), s))
    assert all(0 <= t <= c for t, c in zip(take, counts, strict=True))
    assert sum(a * b for a, b in zip(take, lengths, strict=True)) == best


def test_fit_large_budget_stays_within_and_near():
    lengths, counts = list(range(5, 900, 7)), [50] * 128
    whole = sum(a * b for a, b in zip(lengths, counts, strict=True))
    copies, take = fit(lengths, counts, 1.37 * whole)
    assert copies == 1 and sum(a * b for a, b in zip(lengths, take, strict=True)) == int(1.37 * whole) - whole


def brute_targets(rows):
    size = Counter()
    for _, text, _, source, _ in rows:
        size[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    fixed, total = {}, 1.5 * sum(size.values())
    while True:
        free = [s for s in order if s not in fixed]
        left, w = total - sum(fixed.values()), sum(weight[s] for s in free)
        want = {s: left * weight[s] / w for s in free}
        over = [s for s in free if want[s] > 2 * size[s]]
        if not over:
            return size, fixed | want
        fixed |= {s: 2 * size[s] for s in over}


def test_mix(odd, odd_rows):
    size, target = brute_targets(odd_rows)
    got = mix(odd).collect()
    assert len(got) == len(odd_rows)
    taken = Counter()
    for r in got:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    # No other choice of documents beyond whole copies of the source comes nearer.
    sizes = {s: [r["size"] for r in got if r["source"] == s and r["size"]] for s in size}
    for s in size:
        whole = sum(sizes[s])
        sums = {int(target[s] // whole) * whole if whole else 0}
        for n in sizes[s]:
            sums |= {x + n for x in sums}
        assert abs(taken[s] - target[s]) <= min(abs(x - target[s]) for x in sums) + 1
    again = sorted(map(str, mix(odd).collect()))
    assert again == sorted(map(str, got))


def test_mix_stage_repeats_and_drops(odd, clashing, none):
    taken = Counter()
    for r in mix(odd).collect():
        taken[r["doc_id"], r["source"]] += r["taken"]
    words = Counter()
    for r in mix_stage(clashing).collect():
        words[r["doc_id"], r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    assert +words == +taken
    assert mix_stage(clashing).columns == clashing.columns
    assert mix(none).count() == 0 and mix_stage(none).count() == 0

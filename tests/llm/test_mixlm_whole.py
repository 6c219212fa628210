import zlib

import numpy as np
import pyarrow as pa

from siltstone.llm import mixlm

from .conftest import DOCS, prose


def test_every_training_text_is_learnt_from(spark, monkeypatch):
    """Predictors, mixer and groups learn from all tokens of all training texts: none is left out, none is drawn."""
    texts = {i: prose(i, 400 if i < 3 else 20) for i in range(300)}
    training = {i: t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2}
    seen, tune, mixed, regrouped = {}, mixlm._tune, mixlm.Learner.mixed, mixlm._regrouped

    def watched(vocabulary, ends, code, counts):
        total = lambda name: sum(int(np.frombuffer(mixlm._expand(r[0]), np.int64).sum()) for r in vocabulary.select(name).collect())
        seen.update(code=code, learnt=total("learnt"), ends=int(ends.sum()))
        return tune(vocabulary, ends, code, counts)

    def counted(parts, known):
        known, named = regrouped(parts, known)
        seen.setdefault("named", []).append(int(named.sum()))
        return known, named

    monkeypatch.setattr(mixlm, "GROUP_TEXTS", 30)
    monkeypatch.setattr(mixlm, "_tune", watched)
    monkeypatch.setattr(mixlm, "_regrouped", counted)
    monkeypatch.setattr(mixlm.Learner, "mixed", staticmethod(lambda sums: seen.update(sums=sums) or mixed(sums)))
    assert mixlm.score(spark.createDataFrame([(i, t, "x", "y", len(t)) for i, t in texts.items()], DOCS)).count() == 300
    words = [w for t in training.values() for w in t.encode().lower().split()]
    assert seen["learnt"] == len(words) and seen["ends"] == len(training) and set(seen["named"]) == {len(training)}
    spelt = b"".join(w + b" " for w in words) + b"\n" * len(training)
    nodes = sum(mixlm.Learner.SIZES[:2])
    assert abs(seen["sums"][nodes:].sum() / mixlm.EXACT - seen["code"].length[list(spelt)].sum()) < 2


def test_mixer_learns_what_the_others_say():
    """A token's own count does not tell for it, and sums of slices give one mixer whatever their order."""
    code = mixlm.Code.of(np.bincount([97, 98, 99, 32], minlength=256) * 50)

    def learnt(words, times):
        counts, learner = np.zeros(2 * mixlm.SLOTS, np.int64), mixlm.Learner()
        mixlm._add(counts, pa.array(words, pa.binary()), np.zeros(len(words), np.int64), np.array(times), code)
        learner.learn(pa.array(words, pa.binary()), np.zeros(len(words), np.int64), np.array(times), code, counts.reshape(-1, 2))
        return learner

    # A lone token has nothing to go by, two of a kind have each other.
    alone, twice, more = learnt([b"ab"], [1]), learnt([b"ab"], [2]), learnt([b"ab", b"ba", b"ca"], [100, 50, 20])
    assert alone.curvature.sum() == 0 and (alone.mixer.weights == mixlm.Mixer.new().weights).all() and twice.curvature.sum() > 0
    a, b = mixlm.Learner.mixed(twice.sums() + more.sums()), mixlm.Learner.mixed(more.sums() + twice.sums())
    assert (a.weights == b.weights).all() and (a.refine == b.refine).all() and not (a.weights == mixlm.Mixer.new().weights).all()

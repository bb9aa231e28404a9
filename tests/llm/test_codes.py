import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tsumugi.llm import codes, sketch


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text(alphabet="ab😀", max_size=12), min_size=1, max_size=6), st.integers(1, 5))
def test_windows_lie_in_texts_and_equal_texts_hash_equally(texts, width):
    points, offsets = codes.code_points(texts)
    ok, h, owner = codes.inside(offsets, width, len(points)), codes.Rolling(points).windows(width), codes.owners(offsets)
    whole = "".join(texts)
    expected = [k for i, t in enumerate(texts) for k in range(offsets[i], offsets[i] + len(t) - width + 1)]
    assert np.flatnonzero(ok).tolist() == expected
    seen = {}
    for k in range(len(h)):
        assert seen.setdefault(whole[k : k + width], h[k]) == h[k]
    assert len(set(seen.values())) == len(seen) and len(owner) == len(whole)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(0, 50), max_size=40), st.integers(1, 9))
def test_sliding_min(values, width):
    x = np.array(values, np.uint64)
    assert codes.sliding_min(x, width).tolist() == [min(values[k : k + width]) for k in range(len(values) - width + 1)]


def test_sketch_loses_no_repeated_key(spark):
    keys = [k * 7919 for k in range(4000)] + [k * 7919 for k in range(0, 4000, 10)]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(6)
    bits = sketch.build(df, lambda batch: batch.column(0).to_numpy().view(np.uint64), sketch.width_for(len(keys))).value
    flag = sketch.repeated(bits, np.array(keys[:4000], np.uint64))
    assert flag[::10].all() and flag.sum() < 600
    tiny = sketch.build(df, lambda batch: batch.column(0).to_numpy().view(np.uint64), 1 << 16).value
    assert sketch.repeated(tiny, np.array(keys[:4000:10], np.uint64)).all()
    empty = sketch.build(df.limit(0), lambda batch: batch.column(0).to_numpy().view(np.uint64), 1 << 16).value
    assert not sketch.repeated(empty, np.array(keys[:9], np.uint64)).any()

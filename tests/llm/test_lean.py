import pyarrow as pa
import pytest

from clickloom.llm import arrays


def _batches(n):
    return (pa.record_batch([pa.array([k])], ["k"]) for k in range(n))


def _twice(batches):
    for b in batches:
        yield b
        yield b


@pytest.fixture
def freed(monkeypatch):
    calls = []
    monkeypatch.setattr(arrays, "free_memory", lambda: calls.append(1))
    return calls


def test_all_batches_pass_and_memory_is_freed_once(freed):
    assert [b["k"][0].as_py() for b in arrays.lean(_twice)(_batches(3))] == [0, 0, 1, 1, 2, 2]
    assert len(freed) == 1


def test_memory_is_freed_where_work_breaks_off_or_is_left(freed):
    def broken(batches):
        yield next(batches)
        raise ValueError

    with pytest.raises(ValueError):
        list(arrays.lean(broken)(_batches(2)))
    left = arrays.lean(_twice)(_batches(2))
    next(left)
    left.close()
    assert len(freed) == 2
    assert list(arrays.lean(_twice)(_batches(0))) == []


def test_buckets_get_their_key(freed):
    def keyed(key, batches):
        for b in batches:
            yield key, b.num_rows

    assert list(arrays.lean_bucket(keyed)((7,), _batches(2))) == [((7,), 1), ((7,), 1)] and len(freed) == 1


def test_only_large_groups_free_memory(freed):
    double = arrays.lean_group(lambda t: pa.concat_tables([t, t]))
    assert double(pa.table({"k": [1]})).num_rows == 2 and not freed
    assert double(pa.table({"k": pa.array([0] * (arrays.LARGE // 8 + 1), pa.int64())})).num_rows > arrays.LARGE // 8 and len(freed) == 1


def test_freeing_memory_leaves_data_alone():
    kept = pa.array(range(1000))
    arrays.free_memory()
    assert kept.to_pylist() == list(range(1000))


def test_in_spark(spark):
    def add(batches):
        for b in batches:
            yield pa.record_batch([pa.array([x + 1 for x in b["id"].to_pylist()], pa.int64())], ["id"])

    out = spark.range(10).mapInArrow(arrays.lean(add), "id long")
    assert sorted(r.id for r in out.collect()) == list(range(1, 11))
    groups = out.selectExpr("id % 2 as k", "id").groupBy("k")
    assert {(r.k, r.n) for r in groups.applyInArrow(arrays.lean_group(lambda t: pa.table({"k": t["k"][:1], "n": [t.num_rows]})), "k long, n long").collect()} == {(0, 5), (1, 5)}

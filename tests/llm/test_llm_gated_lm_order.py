"""Order in which a task reads its training documents: a long one that comes last may not go on alone."""
import numpy as np
import pytest

from latentspark.llm import gated_lm as g


def _sequences(lengths):
    return [(i, np.full(n, i % g.END, dtype=np.uint8)) for i, n in enumerate(lengths)]


def test_long_documents_are_begun_first_and_each_is_read_once():
    lengths = [20] * 300 + [3000, 1100, 500, 9000]
    ordered = list(g.long_first(iter(_sequences(lengths))))
    assert sorted(i for i, _ in ordered) == list(range(len(lengths)))
    assert [i for i, _ in ordered] == [303, 300, 301, *range(300), 302]  # short ones stay in order
    windows = lambda s: sum(1 for _ in g.side_by_side(s, 64))
    assert windows(ordered) == -(-9000 // g.WINDOW) < windows(_sequences(lengths))


def test_a_bounded_number_of_tokens_is_held():
    read = []

    def source():
        for item in _sequences([10] * 100 + [2000] + [10] * 100):
            read.append(item[0])
            yield item

    first = next(g.long_first(source(), most=500))
    assert first[0] == 0 and len(read) == 50
    assert len(list(g.long_first(iter(_sequences([10] * 100 + [2000])), most=500))) == 101
    assert not list(g.long_first(iter([])))


def test_training_reads_long_documents_first(monkeypatch, spark):
    """The windows of a task whose long document comes last: as many as that document has, and every token is seen."""
    lengths, seen = [40] * 200 + [6400], []
    monkeypatch.setattr(g, "by_batch", lambda df, fn, schema: seen.append(fn) or df.limit(0).selectExpr("0 i", "0D x", "0D n"))
    words = g.Words({}, np.zeros(0, np.int64), np.zeros(0, np.int64), np.ones(g.CLASSES), np.zeros(g.SHAPES), 1, 1, 0.5)
    g.train(spark.createDataFrame([(1, False, b"")], "doc_id long, held_out boolean, seq binary"), words, deals=1)
    count = []
    windows = g.side_by_side
    monkeypatch.setattr(g, "side_by_side", lambda *a, **k: (count.append(1) or w for w in windows(*a, **k)))
    monkeypatch.setattr(g, "rows_of", lambda batches: ((i, s.tobytes()) for i, s in _sequences(lengths)))
    (batch,) = seen[0](iter([]))
    assert len(count) == 6400 // g.WINDOW
    assert batch.column("n")[0].as_py() == pytest.approx(sum(lengths))

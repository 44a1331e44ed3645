"""Classifier by epochs, partition scores of any number, stored learned index."""

import json
from types import SimpleNamespace

import numpy as np
import pytest
from helpers import base_frame, query_frame, rows, same, vectors
from pyspark.sql import functions as F

from vecsearch.operators import classifier, learned
from vecsearch.operators.classifier import PartitionNet, Rows, train_epochs
from vecsearch.sources import index_store


def labelled_frame(spark, x, k):
    return base_frame(spark, x).withColumn("part", (F.col("id") % k).cast("int"))


def test_gradient_by_differences():
    net = PartitionNet.start(5, 7, 4, 1)
    rng = np.random.default_rng(2)
    x, label = rng.normal(size=(9, 5)), rng.integers(0, 4, 9)
    total = net.gradient(x, label)
    assert total[0] == 9
    at = 1
    for w in net.weights:
        for i in rng.choice(w.size, min(4, w.size), replace=False):
            old = w.flat[i]
            w.flat[i] = old + 1e-6
            up = net.figures(x, label)[1]
            w.flat[i] = old - 1e-6
            down = net.figures(x, label)[1]
            w.flat[i] = old
            assert (up - down) / 2e-6 == pytest.approx(total[at + i], abs=1e-4)
        at += w.size


@pytest.mark.parametrize("partitions", [1, 6])
def test_a_step_over_tasks_equals_a_plain_loop(spark, monkeypatch, partitions):
    monkeypatch.setattr(classifier, "DIRECT_SUMS", 4)  # six tasks: sums are added in two rounds
    x = vectors(200, 6, 3)
    net = PartitionNet.start(6, 12, 5, 4)
    data = Rows(labelled_frame(spark, x, 5).repartition(partitions), 42, 0.8, 4, 10**6)
    kept = data.data.collect()
    for turn in range(4):
        mine = [r for r in kept if r.slot < 800 and r.turn == turn]
        total = net.gradient(np.array([r.embedding for r in mine]), np.array([r.part for r in mine]))
        np.testing.assert_allclose(data.gradient(net, turn), total[1:] / len(mine), atol=1e-12)
    loss, held, accuracy = data.figures(net)
    out = [r for r in kept if r.slot >= 800]
    n, own, right = net.figures(np.array([r.embedding for r in out]), np.array([r.part for r in out]))
    assert held == pytest.approx(own / n) and accuracy == pytest.approx(100 * right / n) and len(kept) == 200
    data.data.unpersist()
    few = Rows(labelled_frame(spark, x, 5), 42, 0.8, 4, 50)
    assert 25 < few.data.count() < 80
    few.data.unpersist()


def test_figures_of_every_epoch(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(4, 6)) * 3
    x = np.concatenate([centres[i % 4][None] + rng.normal(size=(1, 6)) * 0.3 for i in range(400)]).astype(np.float32)
    model, quality = learned.train_partition_model(labelled_frame(spark, x, 4), epochs=6)
    got = quality.orderBy("epoch").collect()
    assert [r.epoch for r in got] == [1, 2, 3, 4, 5, 6] and got[-1].train_loss < got[0].train_loss and got[-1].best_accuracy > 95
    assert [r.best_accuracy for r in got] == list(np.maximum.accumulate([r.val_accuracy for r in got]))
    assert [r.train_loss for r in learned.training_curve(model, spark).collect()] == [r.train_loss for r in got]


def test_a_broken_run_goes_on_behind_the_last_epoch(spark, tmp_path, monkeypatch):
    frame, how = labelled_frame(spark, vectors(150, 6, 5), 3), dict(parts=3, dim=6, hidden=8, seed=1, train_share=0.8, steps=2)
    whole = train_epochs(frame, epochs=4, **how)
    real, calls = Rows.figures, []

    def breaks(self, net):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("executor lost")
        return real(self, net)

    monkeypatch.setattr(Rows, "figures", breaks)
    with pytest.raises(RuntimeError):
        train_epochs(frame, epochs=4, path=str(tmp_path / "state"), **how)
    (tmp_path / "state" / "epoch-0003").mkdir()  # an epoch whose writing broke off
    again = train_epochs(frame, epochs=4, path=str(tmp_path / "state"), **how)
    assert len(calls) == 5 and [h[0] for h in again.history] == [1, 2, 3, 4]
    for a, b in zip(whole.weights, again.weights):
        np.testing.assert_allclose(a, b, atol=1e-9)


@pytest.mark.parametrize("limit", [10**6, 7])
def test_partition_scores_of_any_number(spark, monkeypatch, limit):
    x, q = vectors(40, 5, 1, copies=3), vectors(12, 5, 2)
    cells = base_frame(spark, x).select(F.col("id").cast("int").alias("part"), F.col("embedding").alias("centroid"))
    monkeypatch.setattr(learned, "SMALL_CENTROID_ROWS", limit)
    asked = query_frame(spark, q)
    raw = learned.centroid_scores(asked, cells)
    assert raw.count() == 480
    want = learned.top_partitions(learned.softmax_scores(raw), 6)
    key = lambda df: sorted((r.query_id, r["rank"], r.part, round(r.prob, 10)) for r in df.select("query_id", "rank", "part", "prob").collect())
    assert key(learned.near_partitions(asked, cells, 6)) == key(want)
    assert learned.near_partitions(asked, cells, 100).count() == 480


def test_broken_save_leaves_the_former_pair(spark, tmp_path, monkeypatch):
    path, asked = str(tmp_path / "learned"), query_frame(spark, vectors(20, 6, 4))
    frame, other = labelled_frame(spark, vectors(120, 6, 3), 4), labelled_frame(spark, vectors(150, 6, 9), 6)
    p = learned.LearnedParams(probes=2, epochs=2)
    model, stored, reused = learned.learned_or_train(spark, path, frame, p)
    assert not reused and learned.learned_or_train(spark, path, frame, p)[2]
    assert not learned.learned_or_train(spark, path, frame, learned.LearnedParams(probes=2, epochs=3))[2]
    model, stored, kept = learned.open_learned(spark, path)
    assert kept["learned"]["epochs"] == 3 and [h[0] for h in model.history] == [1, 2, 3]
    want = rows(learned.search_learned(frame, asked, 5, p, labelled=stored, model=model))

    def breaks(*_, **__):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(index_store, "json", SimpleNamespace(dumps=breaks, loads=json.loads))  # after the tables, before the row that names the version
    bigger, _ = learned.train_partition_model(other, epochs=1)
    with pytest.raises(RuntimeError):
        learned.save_learned(path, bigger, other)
    monkeypatch.undo()
    model, stored = learned.load_learned(spark, path)
    assert model.parts == 4 and stored.count() == 120
    same(rows(learned.search_learned(frame, asked, 5, p, labelled=stored, model=model)), want)

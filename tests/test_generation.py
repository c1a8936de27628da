"""Calls in flight, and generating until a target is met."""

import math
import threading
import time

import pytest
from pyspark.sql import functions as F

from textkiln.operators import schedule
from textkiln.sources import providers


class Slow:
    """Counts its calls in flight; fails as told."""

    def __init__(self, seconds=0.03, fails=None):
        self.seconds, self.fails, self.lock, self.now, self.most, self.calls = seconds, fails or {}, threading.Lock(), 0, 0, []

    def generate(self, prompt, system, temperature):
        with self.lock:
            self.now += 1
            self.most = max(self.most, self.now)
            self.calls.append(prompt)
            left = self.fails.get(prompt, 0)
            self.fails[prompt] = left - 1
        try:
            time.sleep(self.seconds)
            if left > 0:
                raise TimeoutError
            return f"re {prompt}"
        finally:
            with self.lock:
                self.now -= 1


def test_many_slow_calls_share_the_workers():
    slow, batches = Slow(), [(b, [f"{b}.{i}" for i in range(7)]) for b in range(12)]
    began = time.perf_counter()
    out = list(providers.answers(iter(batches), slow, "", 0.1, providers.Pool(workers=8)))
    took = time.perf_counter() - began
    assert out == [(b, [f"re {p}" for p in prompts]) for b, prompts in batches]  # in order
    assert slow.most == 8 and took < 3 * 84 * slow.seconds / 8  # refilled over the ends of batches


def test_no_more_is_begun_than_the_window():
    begun = []

    def batches():
        for b in range(40):
            begun.append(b)
            yield b, [str(b)]

    slow = Slow(0.02)
    out = providers.answers(batches(), slow, "", 0.1, providers.Pool(workers=2, window=2))
    next(out)
    assert len(begun) <= 8 and slow.most <= 2
    assert len(list(out)) == 39


def test_failed_calls_are_tried_again_and_then_empty():
    slow = Slow(0.001, {"a": 1, "b": 9})
    pool = providers.Pool(workers=2, tries=3, wait=0.001)
    assert [r for _, r in providers.answers(iter([(0, ["a", "b", "c", None])]), slow, "", 0.1, pool)] == [["re a", "", "re c", "re "]]
    assert (slow.calls.count("a"), slow.calls.count("b"), slow.calls.count("c")) == (2, 3, 1)


def test_replies_stand_beside_their_prompts(spark):
    df = spark.range(500).select(F.concat(F.lit("p"), "id").alias("prompt"), "id")
    got = providers.generate(df, providers.provider("stub"), system="s").collect()
    assert all(r["reply"] == providers.Stub().generate(f"p{r['id']}", "s", 0) for r in got) and len(got) == 500


@pytest.mark.parametrize(("rate", "target"), [(0.8, 300), (0.5, 300), (0.2, 150), (1.0, 200)])
def test_rows_judged_follow_the_pass_rate(spark, rate, target):
    tasks = spark.range(1, 2001).select(F.col("id").alias("task_no"))
    valid = F.pmod(F.xxhash64("task_no"), F.lit(1000)) < int(1000 * rate)
    got = schedule.generate_until(tasks, target, lambda rows: rows.withColumn("ok", valid))
    want = [r["task_no"] for r in tasks.where(valid).orderBy("task_no").limit(target).collect()]
    assert sorted(r["task_no"] for r in got.rows.collect()) == want
    assert got.judged <= 1.1 * max(want[-1], target / rate) + 1


def test_too_few_valid_tasks_and_none(spark):
    tasks = spark.range(1, 101).select(F.col("id").alias("task_no"))
    few = schedule.generate_until(tasks, 80, lambda rows: rows.withColumn("ok", F.col("task_no") % 10 == 0))
    assert few.rows.count() == 10 and few.judged == 100
    none = schedule.generate_until(tasks.limit(0), 5, lambda rows: rows.withColumn("ok", F.lit(True)))
    assert none.rows.count() == 0 and none.judged == 0
    assert math.ceil(none.rounds) == 0

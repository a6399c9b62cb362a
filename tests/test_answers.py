"""Stored answers: what is asked again, what is not, and what a failing model leaves."""

from pyspark.sql import functions as F

from leadlake.operators import answers, insights


def prompts(spark, *rows):
    return spark.createDataFrame(list(rows), "lead_id string, system_prompt string, user_prompt string")


def reply_to(pairs):
    return ['{"intent_score": %d}' % len(user or "") for _, user in pairs]


def broken(pairs):
    raise RuntimeError("down")


def ask(spark, tmp_path, run, model, *rows, **limits):
    out = answers.ask(prompts(spark, *rows), model, str(tmp_path / "a"), run, **limits)
    return sorted((r.lead_id, r.response) for r in out.collect())


def tries(spark, tmp_path):
    return answers.stored(spark, str(tmp_path / "a"))


def test_equal_prompts_are_asked_once_and_never_again(spark, tmp_path):
    rows = [("1", "s", "aa"), ("2", "s", "aa"), ("3", "s", "bbb"), ("4", None, "aa"), ("5", "", "aa")]
    first = ask(spark, tmp_path, "r1", reply_to, *rows)
    assert first == [(i, '{"intent_score": %d}' % n) for i, n in zip("12345", (2, 2, 3, 2, 2))]
    assert tries(spark, tmp_path).count() == 4
    assert ask(spark, tmp_path, "r2", broken, *rows) == first
    assert ask(spark, tmp_path, "r3", reply_to, *rows, ("6", "s", None))[-1] == ("6", '{"intent_score": 0}')
    assert tries(spark, tmp_path).count() == 5
    assert ask(spark, tmp_path, "r4", reply_to) == []


def test_failures_are_recorded_and_asked_again(spark, tmp_path):
    rows = [("1", "s", "aa"), ("2", "s", "bbb")]
    assert ask(spark, tmp_path, "r1", broken, *rows) == []
    assert {(r.response, r.error) for r in tries(spark, tmp_path).collect()} == {(None, "RuntimeError: down")}
    short = lambda pairs: reply_to(pairs)[:-1]
    assert ask(spark, tmp_path, "r2", short, *rows) == []
    text = lambda pairs: ["sorry"] * len(pairs)
    assert ask(spark, tmp_path, "r3", text, *rows) == []
    assert [r[0] for r in ask(spark, tmp_path, "r4", reply_to, *rows)] == ["1", "2"]
    assert tries(spark, tmp_path).groupBy("run").count().count() == 4


def test_limits_of_batches_and_attempts(spark, tmp_path):
    def picky(pairs):
        assert len(pairs) <= 2
        return [reply_to([pairs[0]])[0]] + [None] * (len(pairs) - 1)

    rows = [(str(i), "s", "x" * i) for i in range(1, 5)]
    assert len(ask(spark, tmp_path, "r1", picky, *rows, batch_rows=2, attempts=2)) == 4
    again = [("a", "s", "p"), ("b", "s", "qq")]
    out = answers.ask(prompts(spark, *again).coalesce(1), picky, str(tmp_path / "b"), "r1", batch_rows=2, attempts=1)
    assert out.count() <= 2 and answers.stored(spark, str(tmp_path / "b")).count() == 2


def test_as_scorer_of_a_stage(spark, tmp_path):
    leads = spark.createDataFrame([("1", "Ann Lee"), ("2", None)], "lead_id string, full_name string")
    scorer = answers.cached(reply_to, str(tmp_path / "a"), "r1")
    out = insights.run_stage(leads, insights.INTENT, scorer)
    assert out.filter(F.col("intent_score") > 50).count() == 2

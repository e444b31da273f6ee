"""Batch scoring with pluggable providers, and the checks on what they return."""

from __future__ import annotations

import math
import random
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.bind import bind
from ..functions.text import word_runs
from ..schemas import CATCH_ALL, CLASSIFICATION, CONFIDENCES, KEYWORD_RULES, TAXONOMY
from ..session import discard, materialise, new_folder, read_if_there
from .skew import join_skewed

RESPONSE = "request_hash string, response string, attempts int, status string"


class ScoreProvider:
    """Scores batches of requests; subclass and override :meth:`score`.

    Input frames have ``request_hash`` and ``prompt``; output frames follow
    ``RESPONSE``. One instance is shipped to each task, so clients should be
    opened lazily inside :meth:`score`.
    """

    def score(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raise NotImplementedError

    def at_rate(self, calls_per_minute: float) -> ScoreProvider:
        """This provider limited to a call rate per task."""
        raise NotImplementedError("this provider does not limit its rate")


@dataclass(frozen=True)
class CallProvider(ScoreProvider):
    """Wraps ``call(prompt) -> text`` with retries and a per-task call rate.

    Retry k uses ``step_down[k - 1]`` in place of ``call`` where given, so that a
    failing model can be replaced by a simpler one. Waits vary by ``jitter`` and
    retries end once they would wait longer than ``max_wait`` in total. A request
    that keeps failing, or answers with nothing, becomes a row with status
    ``fallback``; it never fails the task, which would pay for the whole
    partition again.
    """

    call: Callable[[str], str]
    attempts: int = 3
    waits: Sequence[float] = (1.0, 2.0)
    jitter: float = 0.3
    max_wait: float = 30.0
    step_down: Sequence[Callable[[str], str]] = ()
    calls_per_minute: float | None = None

    def at_rate(self, calls_per_minute: float) -> CallProvider:
        return replace(self, calls_per_minute=calls_per_minute)

    def _once(self, prompt: str) -> tuple[str | None, int]:
        models = (self.call, *self.step_down)
        waited = 0.0
        for attempt in range(self.attempts):
            try:
                return models[min(attempt, len(models) - 1)](prompt), attempt + 1
            except Exception:  # noqa: BLE001 - any client error is retried
                pause = self.waits[min(attempt, len(self.waits) - 1)] if self.waits else 0.0
                pause *= random.uniform(1 - self.jitter, 1 + self.jitter)
                if attempt + 1 == self.attempts or waited + pause > self.max_wait:
                    return None, attempt + 1
                time.sleep(pause)
                waited += pause
        return None, self.attempts

    def score(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gap = 60.0 / self.calls_per_minute if self.calls_per_minute else 0.0
        due = time.monotonic()
        for batch in batches:
            rows = []
            for request, prompt in zip(batch["request_hash"], batch["prompt"]):
                if gap:
                    time.sleep(max(0.0, due - time.monotonic()))
                    due = max(due, time.monotonic()) + gap
                text, attempts = self._once(prompt)
                rows.append((request, text or None, attempts, "ok" if text else "fallback"))
            yield pd.DataFrame(rows, columns=["request_hash", "response", "attempts", "status"])


def score(
    requests: DataFrame, provider: ScoreProvider, store_path: str, tasks: int | None = None,
    calls_per_minute: float | None = None, commits: int = 4,
) -> DataFrame:
    """Add ``response``, ``attempts``, ``status`` to ``requests`` by their ``prompt``.

    Equal prompts are scored once. Answers go to the table at ``store_path``
    before anyone reads them, so a second consumer repeats no call; requests
    answered by an earlier run are skipped, failed ones are tried again. The
    requests are asked in ``commits`` parts, each written when it is done, so a
    run that breaks off loses the answers of one part at most. ``tasks``
    bounds the concurrent callers, among whom ``calls_per_minute`` is divided.
    Keep ``spark.speculation`` off for paid calls.
    """
    if calls_per_minute:
        if not tasks:
            raise ValueError("a call rate needs a number of tasks to divide it among")
        provider = provider.at_rate(calls_per_minute / tasks)
    spark = requests.sparkSession
    hashed = requests.withColumn("request_hash", F.sha2(F.coalesce("prompt", F.lit("")), 256))
    wanted = hashed.groupBy("request_hash").agg(F.min("prompt").alias("prompt"))
    done = read_if_there(spark, store_path, RESPONSE)
    if done is not None:
        wanted = wanted.join(done.where("status = 'ok'").select("request_hash").distinct(), "request_hash", "left_anti")
    part = F.pmod(F.xxhash64("request_hash"), F.lit(commits))
    wanted = materialise(wanted, "requests")
    for number in range(commits):
        asked = wanted.where(part == number)
        if tasks:
            asked = asked.repartition(tasks)
        asked.mapInPandas(provider.score, RESPONSE).write.mode("append").parquet(store_path)
    discard(wanted)
    answers = (
        spark.read.schema(RESPONSE).parquet(store_path)
        .groupBy("request_hash")
        .agg(F.max_by(F.struct("response", "attempts", "status"), F.struct(F.col("status") == "ok", "attempts")).alias("_a"))
        .select("request_hash", "_a.*")
    )
    return join_skewed(hashed, answers, ["request_hash"])


def validate_classification(response: Column, failure: str = "Failed to parse response") -> Column:
    """JSON text -> checked classification with ``parse_status``; bad text -> fallback row.

    Unparsable text yields a struct of nulls, so required fields are tested, not
    the struct. ``topic_category`` has no default: the key itself must be there.
    """
    parsed = F.from_json(response, CLASSIFICATION, {"mode": "PERMISSIVE"})
    empty = F.array().cast("array<string>")
    keys = F.json_object_keys(F.when(F.try_parse_json(response).isNotNull(), response))
    # The key may be absent, but a null is not a list.
    secondary = F.when(~F.array_contains(keys, "secondary_categories"), empty).otherwise(parsed["secondary_categories"])
    valid = (
        secondary.isNotNull()
        & parsed["is_news"].isNotNull()
        & parsed["reason"].isNotNull()
        & parsed["confidence"].isin(*CONFIDENCES)
        & (parsed["primary_category"].isNull() | parsed["primary_category"].isin(*TAXONOMY))
        & F.forall(secondary, lambda c: F.coalesce(c.isin(*TAXONOMY), F.lit(False)))
        & F.array_contains(keys, "topic_category")
    )
    valid = F.coalesce(valid, F.lit(False))

    def kept(value: Column, fallback: Column) -> Column:
        return F.when(valid, value).otherwise(fallback)

    none = F.lit(None).cast("string")
    return F.struct(
        kept(parsed["is_news"], F.lit(False)).alias("is_news"),
        kept(parsed["confidence"], F.lit("low")).alias("confidence"),
        kept(parsed["reason"], F.lit(failure)).alias("reason"),
        kept(parsed["primary_category"], none).alias("primary_category"),
        kept(secondary, empty).alias("secondary_categories"),
        kept(parsed["topic_category"], none).alias("topic_category"),
        F.when(valid, "ok").otherwise("fallback").alias("parse_status"),
    )


def classify_rules(messages: DataFrame, rules: Sequence[tuple[str, Sequence[str]]] = KEYWORD_RULES) -> DataFrame:
    """Offline default classifier: keywords that stand as whole words in subject and body.

    The category with most distinct keywords wins, earlier rules win ties; other
    categories with at least two keywords are secondary. No hit means not news.
    """
    def scored(text: Column) -> Column:
        return F.array(*[
            F.struct(
                sum((F.contains(text, word_runs(F.lit(k))).cast("int") for k in keywords), F.lit(0)).alias("hits"),
                F.lit(-i).alias("order"), F.lit(name).alias("category"),
            ) for i, (name, keywords) in enumerate(rules)
        ])

    # The text is bound, since a filter on the result that moves down would repeat it for every keyword.
    scores = bind(word_runs(F.concat_ws("\n", F.col("subject"), F.col("body"))), scored)
    found = messages.withColumn("_scores", scores).withColumn("_best", F.array_max("_scores"))
    is_news = F.col("_best.hits") > 0
    primary = F.when(is_news, F.col("_best.category"))
    secondary = F.transform(
        F.filter("_scores", lambda s: (s["hits"] >= 2) & (s["category"] != F.col("_best.category"))),
        lambda s: s["category"],
    )
    return found.select(
        *messages.columns,
        is_news.alias("is_news"),
        F.when(F.col("_best.hits") >= 3, "high").when(F.col("_best.hits") == 2, "medium").otherwise("low").alias("confidence"),
        F.when(is_news, F.concat(F.lit("News: "), primary, F.lit(" - "), F.col("subject")))
        .otherwise("Not News: no topic keywords").alias("reason"),
        primary.alias("primary_category"),
        F.when(is_news, secondary).otherwise(F.array().cast("array<string>")).alias("secondary_categories"),
    )


def classify_trained(messages: DataFrame, examples: DataFrame, features: int = 1 << 14) -> DataFrame:
    """Offline trainable classifier: term frequencies and logistic regression.

    ``examples`` has subject, body and ``is_news``; the model is of fixed size. It is written and read back: a model that
    was just fitted holds its session through its summary, and a session that has observed a metric cannot be sent to tasks.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer

    text = F.concat_ws("\n", F.col("subject"), F.col("body"))
    stages = [
        RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol="_label", predictionCol="_predicted", maxIter=20, regParam=0.01),
    ]
    training = examples.select(text.alias("_text"), F.col("is_news").cast("double").alias("_label"))
    model = Pipeline(stages=stages).fit(training)
    folder = new_folder(messages.sparkSession, "model")
    model.stages[-1].save(folder)
    model.stages[-1] = LogisticRegressionModel.load(folder)
    scored = model.transform(messages.withColumn("_text", text))
    return scored.select(*messages.columns, (F.col("_predicted") == 1.0).alias("is_news"))


def classify_counts(messages: DataFrame, examples: DataFrame, key: str = "message_id") -> DataFrame:
    """Offline classifier from counts alone: naive Bayes over the words that a mail has, with ``log_odds`` of being news.

    ``examples`` has subject, body and ``is_news``. A word weighs by the shares of the news and of the other examples that have it,
    each with one example more that has it and one that has not; words that no example has weigh nothing. ``key`` tells messages apart.
    """
    def distinct_words(df: DataFrame, *columns: str) -> DataFrame:
        text = F.concat_ws("\n", F.col("subject"), F.col("body"))
        return df.select(*columns, F.explode(F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != ""))).alias("word"))

    news, others = examples.agg(F.count_if("is_news"), F.count_if(~F.col("is_news"))).first()
    counted = distinct_words(examples, "is_news").groupBy("word").agg(
        F.count_if("is_news").alias("n_news"), F.count_if(~F.col("is_news")).alias("n_others"))
    weight = F.log((F.col("n_news") + 1) / (news + 2)) - F.log((F.col("n_others") + 1) / (others + 2))
    weighed = counted.select("word", weight.alias("weight"))
    summed = join_skewed(distinct_words(messages, key), weighed, ["word"]).groupBy(key).agg(F.sum("weight").alias("_sum"))
    odds = math.log((news + 1) / (others + 1)) + F.coalesce("_sum", F.lit(0.0))
    return messages.join(summed, key, "left").select(*messages.columns, odds.alias("log_odds"), (odds > 0).alias("is_news"))


def news_only(classified: DataFrame) -> DataFrame:
    """Messages to keep; the plain predicate can move below joins and projections."""
    return classified.where("is_news")


def rolling_calls(calls: DataFrame, key: str, at: str, limit: int, seconds: int = 60) -> DataFrame:
    """Calls made in the trailing window of each call, and whether that breaks ``limit``.

    The window excludes a call exactly ``seconds`` old. A busy key does not end
    up in one task: time is cut into buckets of the window's length, each call is
    copied into the next bucket as context, and windows run per (key, bucket).
    """
    from pyspark.sql import Window

    span = seconds * 1_000_000
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    stamped = calls.withColumn("_us", micros).withColumn("_own", F.floor(F.col("_us") / span).cast("long"))
    spread = stamped.withColumn("_bucket", F.explode(F.array(F.col("_own"), F.col("_own") + 1)))
    recent = Window.partitionBy(key, "_bucket").orderBy("_us").rangeBetween(-(span - 1), 0)
    counted = spread.withColumn("calls_in_window", F.count("*").over(recent)).where("_bucket = _own")
    return counted.select(
        *calls.columns, "calls_in_window", (F.col("calls_in_window") > limit).alias("over_limit")
    )

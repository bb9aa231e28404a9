"""The engine: analysis, and rounds of requests, answers, validation and acceptance."""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsumugi import schemas
from tsumugi.config import Config
from tsumugi.operators import accept, allocate, parse, profile, prompts, quality, represent
from tsumugi.sources import files
from tsumugi.sources.providers import Provider


@dataclass
class Analysis:
    totals: DataFrame
    by_category: DataFrame
    deficits: DataFrame
    length_stats: DataFrame


@dataclass
class Engine:
    """Balances a corpus (``schemas.CORPUS``) to ``config.target`` rows a category with samples of a provider.

    ``folder`` holds, under a fingerprint of the options and tables, each round's requests, answers and validated candidates. A run
    that stopped goes on from there, and keeps its ``run_id``, if these are the same; else it begins anew beside the older one.
    """

    spark: SparkSession
    corpus: DataFrame
    styles: DataFrame
    allowed: DataFrame
    definitions: DataFrame
    folder: str
    config: Config = Config()
    run_id: str | None = None
    place: str = field(init=False, default="")

    def analyze(self) -> Analysis:
        c = self.config
        return Analysis(profile.totals(self.corpus, c.target, c.least_valid), profile.category_counts(self.corpus), profile.deficits(self.corpus, c.target), profile.length_stats(self.corpus))

    def shown(self) -> DataFrame:
        """Each category's representatives with their texts."""
        return represent.shown(profile.valid_samples(self.corpus, self.config.least_valid), self.config.mutual_similarity, self.config.seed)

    def fingerprint(self) -> str:
        """A hash of the options that decide what a run gives, and of all rows of its tables, in whatever order."""
        tables = [(self.corpus, schemas.CORPUS), (self.styles, schemas.STYLE), (self.allowed, schemas.ALLOWED_STYLE), (self.definitions, schemas.DEFINITION)]
        sums = []
        for df, schema in tables:
            names = [c.split()[0] for c in schema.split(", ")]
            sums.append(tuple(df.select(F.xxhash64(*names).cast("decimal(38,0)").alias("h")).agg(F.count("*"), F.sum("h"), F.sum(F.col("h") % 1_000_003 * (F.col("h") % 998_244_353))).first()))
        same = {f: getattr(Config, f) for f in ("concurrency", "retries", "backoff_base", "requests_per_minute", "call_seconds", "max_rounds")}  # a run may go on with others
        return hashlib.sha256(repr((replace(self.config, **same), sums)).encode()).hexdigest()[:16]

    def _open(self) -> None:
        """Find the place of this run, and its id: the one kept there, which a given one must equal; else the given one or a new one."""
        self.place = f"{self.folder}/{self.fingerprint()}"
        kept = f"{self.place}/run"
        if files.exists(self.spark, f"{kept}/_SUCCESS"):
            known = self.spark.read.schema("run_id string").json(kept).first()[0]
            if self.run_id not in (None, known):
                raise ValueError(f"{self.place} holds run {known}")
            self.run_id = known
        else:
            self.run_id = self.run_id or uuid.uuid4().hex
            self.spark.createDataFrame([(self.run_id,)], "run_id string").coalesce(1).write.mode("overwrite").json(kept)

    def _answers(self, provider: Provider, asked: DataFrame, round_: int) -> DataFrame:
        """The round's answers, kept in parts of about ``config.save_interval`` categories; only what no finished part has is asked for."""
        path = f"{self.place}/answers/round={round_}"
        parts = max(1, -(-asked.select("category").distinct().count() // max(1, self.config.save_interval)))
        read = lambda done: self.spark.read.schema(schemas.ANSWER).parquet(*[f"{path}/part={k}" for k in done])
        done = [k for k in range(parts) if files.exists(self.spark, f"{path}/part={k}/_SUCCESS")]
        left = files.pending(asked, read(done)) if done else asked
        for k in range(parts):
            if k not in done:
                own = left.where(F.pmod(F.xxhash64("category"), F.lit(parts)) == k)
                provider.answer(own).select(*[c.split()[0] for c in schemas.ANSWER.split(", ")]).write.mode("overwrite").parquet(f"{path}/part={k}")
        return read(range(parts))

    def _kept(self, df: DataFrame, name: str, round_: int) -> DataFrame:
        path = f"{self.place}/{name}"
        if not files.exists(self.spark, f"{path}/round={round_}/_SUCCESS"):
            files.append_round(df, path, round_)
        return self.spark.read.parquet(f"{path}/round={round_}").withColumn("round", F.lit(round_))

    def run(self, provider: Provider) -> DataFrame:
        """Output rows (``schemas.OUTPUT``). Each round asks for what is still missing, ``config.max_rounds`` at most."""
        c = self.config
        self._open()
        matrix = allocate.style_matrix(profile.deficits(self.corpus, c.target), self.styles, self.allowed, c.most_styles, c.least_per_style)
        lists = self._kept(prompts.examples(self.shown(), c.example_chars), "examples", 0).drop("round")
        references = profile.valid_samples(self.corpus, c.least_valid).select(F.col("row_id").alias("id"), "category", F.col("body").alias("text")).dropDuplicates(["id"])
        passing, need = None, matrix
        for round_ in range(c.max_rounds):
            asked = self._kept(prompts.requests(need, self.definitions, self.styles, lists, c, round_), "requests", round_)
            if asked.isEmpty():
                break
            answers = self._answers(provider, asked, round_)
            samples = parse.candidates(answers, c.per_request).withColumn("id", F.xxhash64("category", "style", "round", "batch_idx", "sample_idx"))
            validated = self._kept(quality.validate(samples, references, self.styles, c), "validated", round_)
            found = validated.where("passed").join(asked.select("category", "style", "batch_idx", "seed_ids"), ["category", "style", "batch_idx"])
            passing = found if passing is None else passing.unionByName(found, allowMissingColumns=True)
            have = passing.groupBy("category", "style").agg(F.count("*").alias("have"))
            need = matrix.join(have, ["category", "style"], "left").withColumn("needed", (F.col("needed") - F.coalesce("have", F.lit(0))).cast("int")).where("needed > 0").drop("have")
        if passing is None:
            return self.spark.createDataFrame([], schemas.OUTPUT)
        return accept.stamped(accept.first_n(passing, matrix, c.target), c.model, self.run_id)

    def summary(self, output: DataFrame) -> DataFrame:
        return profile.style_distribution(output)

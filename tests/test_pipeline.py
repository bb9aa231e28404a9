import asyncio
import http.server
import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from tsumugi import cli, schemas
from tsumugi.config import Config
from tsumugi.operators import accept, profile, prompts
from tsumugi.plans.pipeline import Engine
from tsumugi.sources import files
from tsumugi.sources.providers import ChatProvider, ChatService, Pace, ReplayProvider, call

CORPUS = [(i, f"題{i}", f"{'甲乙丙丁'[i % 4]}社は第{i}工場の計画を公表した。" * 9, "設備" if i < 6 else "採用") for i in range(10)] + [(10, None, None, None), (11, "", "", "設備")]
STYLES = [(0, "速報", "短い", "常体", None, None, 120, 600), (1, "解説", "長い", None, 2, 60, 120, 600)]


def body(k):
    return "".join(f"第{k}区の{w}案は{k * 7 + j}件の意見を受けて改めた。" for j, w in enumerate("春夏秋冬朝昼夕夜"))


@pytest.fixture
def engine(spark, tmp_path):
    frame = spark.createDataFrame
    return Engine(spark, frame(CORPUS, schemas.CORPUS), frame(STYLES, schemas.STYLE), frame([], schemas.ALLOWED_STYLE), frame([("設備", "設備の文章")], schemas.DEFINITION), str(tmp_path / "rounds"), Config(target=12), run_id="r")


def answer(category, style, k):
    return json.dumps([{"title": f"題名{k}-{j}", "body": body(k * 3 + j), "category": category, "style": style, "mood": "calm"} for j in range(3)], ensure_ascii=False)


def test_run_and_resume(spark, engine):
    asked = prompts.requests(spark.createDataFrame([("設備", "速報", 0, 5), ("採用", "速報", 0, 8)], schemas.ALLOCATION), engine.definitions, engine.styles, prompts.examples(engine.shown()), engine.config).collect()
    recorded = spark.createDataFrame([(r["category"], r["style"], 0, r["batch_idx"], answer(r["category"], r["style"], i * 5 + 2), None) for i, r in enumerate(asked)], schemas.ANSWER)
    output = engine.run(ReplayProvider(recorded))
    rows = output.collect()
    assert output.columns == [c.split()[0] for c in schemas.OUTPUT.split(", ")]
    counts = {c: sum(r["category"] == c for r in rows) for c in ("設備", "採用")}
    assert counts == {"設備": 5, "採用": 8}
    assert all(r["is_synth"] and r["gen_model"] == "replay" and r["seed_ids"] for r in rows) and len({r["uuid"] for r in rows}) == len(rows)
    again = engine.run(ReplayProvider(recorded.limit(0)))  # what is kept isn't asked for again
    assert {r["uuid"] for r in again.collect()} == {r["uuid"] for r in rows}


def test_rounds_ask_for_what_is_missing(spark, engine):
    engine.config = Config(target=12, max_rounds=2)
    recorded = [("設備", "速報", 0, 0, answer("設備", "速報", 1), None), ("設備", "速報", 1, 0, answer("設備", "速報", 40), None), ("採用", "速報", 0, 0, "no json", None)]
    got = engine.run(ReplayProvider(spark.createDataFrame(recorded, schemas.ANSWER))).collect()
    assert [r["category"] for r in got] == ["設備"] * 5


class Counting:
    """Answers that never parse; fails from the request for one category on."""

    def __init__(self, fails=None):
        self.asked, self.fails = [], fails

    def answer(self, requests):
        rows = requests.collect()
        if any(r["category"] == self.fails for r in rows):
            raise OSError("service is down")
        self.asked += [r["category"] for r in rows]
        return requests.select("category", "style", "round", "batch_idx", F.lit("no json").alias("content"), F.lit(None).cast("string").alias("error"))


def test_a_round_that_stopped_asks_for_the_rest_only(spark, engine):
    engine.config = Config(target=12, save_interval=1)
    stopped = Counting()
    stopped.fails = "採用"
    with pytest.raises(OSError):
        engine.run(stopped)
    rest = Counting()
    engine.run(rest)
    assert {*stopped.asked, *rest.asked} == {"設備", "採用"} and not {*stopped.asked} & {*rest.asked}


def test_other_options_or_rows_begin_anew(spark, engine):
    first = Counting()
    engine.run(first)
    place = engine.place
    engine.config = Config(target=50)
    more = Counting()
    engine.run(more)
    assert engine.place != place and len(more.asked) > len(first.asked)
    engine.config = Config(target=12, concurrency=9, max_rounds=1)
    again = Counting()
    engine.run(again)
    assert engine.place == place and again.asked == []
    engine.corpus = engine.corpus.where("row_id <> 1")
    other = Counting()
    engine.run(other)
    assert engine.place != place and other.asked
    with pytest.raises(ValueError):
        Engine(spark, engine.corpus, engine.styles, engine.allowed, engine.definitions, engine.folder, engine.config, run_id="another").run(other)
    kept = Engine(spark, engine.corpus, engine.styles, engine.allowed, engine.definitions, engine.folder, engine.config)
    kept.run(other)
    assert kept.run_id == "r"


def test_first_n_is_bounded_and_ordered(spark):
    rows = spark.createDataFrame([("a", "s", 0, b, 0) for b in range(9, -1, -1)], "category string, style string, round int, batch_idx int, sample_idx int")
    need = spark.createDataFrame([("a", "s", 3)], "category string, style string, needed int")
    assert sorted(r["batch_idx"] for r in accept.first_n(rows, need, 100).collect()) == [0, 1, 2]


def test_profile_of_an_empty_corpus(spark):
    empty = spark.createDataFrame([], schemas.CORPUS)
    assert tuple(profile.totals(empty).first()) == (0, 0, 0, 0, 0)
    assert profile.length_stats(empty).count() == profile.deficits(empty).count() == 0


def test_calls_release_their_slot_while_waiting():
    tries = []

    async def chat(messages):
        tries.append(1)
        if len(tries) < 3:
            raise OSError("busy")
        return " ok "

    async def run():
        return await asyncio.wait_for(call(chat, [], asyncio.Semaphore(1), Config(backoff_base=0)), 5)

    assert asyncio.run(run()) == ("ok", None)


def test_empty_answers_are_retried_only_on_request():
    async def empty(messages):
        return ""

    run = lambda c: asyncio.run(call(empty, [], asyncio.Semaphore(1), c))
    assert run(Config(backoff_base=0)) == ("", None) and run(Config(backoff_base=0, retry_on_empty=True)) == (None, "empty answer")


def test_calls_are_paced_and_time_out():
    async def chat(messages):
        began.append(time.monotonic())
        return "x"

    async def hangs(messages):
        await asyncio.sleep(9)

    async def run():
        pace, slots = Pace(60 / 0.05), asyncio.Semaphore(9)
        await asyncio.gather(*[call(chat, [], slots, Config(), pace) for _ in range(5)])
        return await call(hangs, [], slots, Config(call_seconds=0.05, retries=2, backoff_base=0))

    began = []
    assert asyncio.run(run()) == (None, "TimeoutError: ")
    assert all(b - a > 0.045 for a, b in zip(began, began[1:]))


@pytest.fixture
def service():
    """A chat service that repeats what it was sent."""
    seen = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            sent = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            seen.append((self.path, self.headers["Authorization"], sent))
            made = json.dumps({"choices": [{"message": {"content": json.dumps([{"title": "題", "body": body(len(seen)), "category": "設備", "style": "速報"}], ensure_ascii=False)}}]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(made)

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/v1", seen
    server.shutdown()


def test_chat_service_sends_the_sampling_options(service, monkeypatch):
    endpoint, seen = service
    monkeypatch.setenv("CHAT_API_KEY", "k")
    config = Config(model="m", temperature=0.3, max_tokens=77)
    content = asyncio.run(ChatService(endpoint, config).connect()([{"role": "user", "content": "q"}]))
    assert json.loads(content)[0]["title"] == "題"
    assert seen == [("/v1/chat/completions", "Bearer k", {"model": "m", "temperature": 0.3, "max_tokens": 77, "presence_penalty": 0.3, "frequency_penalty": 0.2, "messages": [{"role": "user", "content": "q"}]})]


def test_cli_asks_a_service(spark, tmp_path, monkeypatch, service):
    endpoint, seen = service
    monkeypatch.setattr(cli, "session", lambda: spark)
    monkeypatch.delenv("SOME_KEY", raising=False)
    frame, path = spark.createDataFrame, lambda name: str(tmp_path / name)
    frame(CORPUS, schemas.CORPUS).write.parquet(path("in.parquet"))
    frame(STYLES, schemas.STYLE).write.parquet(path("styles.parquet"))
    asked = ["--input", path("in.parquet"), "--output", path("out.parquet"), "--styles", path("styles.parquet"), "--endpoint", endpoint, "--key-name", "SOME_KEY", "--env-file", path(".env"), "--target", "12", "--run-id", "r1", "--model", "m"]
    assert cli.main(asked) == 1 and not seen  # no key
    monkeypatch.setattr(spark, "stop", lambda: None)
    (tmp_path / ".env").write_text("# keys\nexport SOME_KEY='abc'\n")
    try:
        assert cli.main(asked) == 0
    finally:
        os.environ.pop("SOME_KEY", None)
    assert seen and {s[2]["model"] for s in seen} == {"m"}
    out = spark.read.parquet(path("out.parquet")).collect()
    assert out and all(r["gen_model"] == "m" for r in out)


def test_chat_provider(spark):
    def connect():
        async def chat(messages):
            return f"{messages[-1]['content']}!"

        return chat

    asked = spark.createDataFrame([("a", "s", 0, 0, i, [("user", f"q{i}")], [], []) for i in range(5)], schemas.REQUEST)
    assert sorted(r["content"] for r in ChatProvider(connect, tasks=2).answer(asked).collect()) == [f"q{i}!" for i in range(5)]


def test_files(spark, tmp_path):
    (tmp_path / "c.csv").write_text('title,body,category\na,"x\n""y""",k\nb,NA,\n', encoding="utf-8")
    df = files.read_corpus(spark, str(tmp_path / "c.csv"))
    assert [tuple(r) for r in df.orderBy("row_id").collect()] == [(0, "a", 'x\n"y"', "k"), (1, "b", "NA", None)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        spark.range(900).select(F.concat(F.lit("t"), "id").alias("title"), F.lit("b").alias("body"), F.lit("c").alias("category"), F.lit(1).alias("x")).repartitionByRange(5, "title").write.json(str(tmp_path / "many.json"))
        plain = spark.read.json(str(tmp_path / "many.json")).select("title", "_metadata.file_path", F.monotonically_increasing_id().alias("at")).collect()
        many = files.read_corpus(spark, str(tmp_path / "many.json"))
        assert many.columns == ["row_id", "title", "body", "category", "x"]
        number = {r["title"]: r["row_id"] for r in many.collect()}
        by_file = {}
        for r in sorted(plain, key=lambda r: (r["file_path"], int(r["title"][1:]))):
            by_file.setdefault(r["file_path"], []).append(number[r["title"]])
        assert sorted(number.values()) == list(range(900))
        assert [sorted(v) for _, v in sorted(by_file.items())] == [list(range(sum(map(len, list(by_file.values())[:k])), sum(map(len, list(by_file.values())[: k + 1])))) for k in range(len(by_file))]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    with pytest.raises(FileNotFoundError):
        files.read(spark, str(tmp_path / "absent.csv"))
    out = spark.createDataFrame([("t", ["1", "2"])], "title string, seed_ids array<string>")
    for ending in ("csv", "json", "parquet"):
        files.write(out, str(tmp_path / f"o.{ending}"))
        assert files.read(spark, str(tmp_path / f"o.{ending}")).count() == 1
    assert files.read(spark, str(tmp_path / "o.csv")).first()["seed_ids"] == '["1","2"]'
    assert files.read_definitions(spark, str(tmp_path / "none.parquet")).count() == 0


def test_examples_and_prompt(spark):
    shown = spark.createDataFrame([("c", 5, 0, "　", " x" * 300), ("c", 7, 1, "t", "b")], "category string, row_id bigint, rep_rank int, title string, body string")
    e = prompts.examples(shown).first()
    assert e["seed_ids"] == ["5", "7"] and e["examples"][0]["title"] == prompts.NO_TITLE and len(e["examples"][0]["body"]) == 200
    p = prompts.with_instruction(spark.createDataFrame([("unknown",)], "style string"), spark.createDataFrame(STYLES, schemas.STYLE)).first()["instruction"]
    assert p.startswith("Style: 速報") and "Title" not in p


def test_cli_dry_run_and_missing_input(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda: spark)
    spark.createDataFrame(CORPUS, schemas.CORPUS).write.parquet(str(tmp_path / "in.parquet"))
    assert cli.main(["--input", str(tmp_path / "in.parquet"), "--dry-run"]) == 0
    assert cli.main(["--input", str(tmp_path / "absent.parquet")]) == 1


def test_streaming_equals_batch(spark, tmp_path):
    from tsumugi.streaming import quality as sq

    rows = [(9, "廃止", "題", body(9))] + [(i, "速報", "題", None if i == 3 else body(i) if i % 2 else "短い。") for i in range(8)] + [(1, "速報", "題", body(1))]
    df = spark.createDataFrame(rows, "id bigint, style string, title string, body string").withColumn("at", F.timestamp_seconds(F.col("id") * 600 + 1_700_000_000))
    styles = spark.createDataFrame(STYLES, schemas.STYLE)
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    sq.sink(sq.checked(sq.first_of_each(stream, "id", "at"), styles), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {r["id"]: r["reasons"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {r["id"]: r["reasons"] for r in sq.checked(df.dropDuplicates(["id"]), styles).collect()}
    assert got[3] == ["malformed"] and got[0] == ["length", "language"] and got[1] == []
    assert got[9] == ["length"]  # an unknown style has the default ranges, as in validate
    counted = sq.pass_counts(sq.checked(df, styles), "at").collect()
    assert sum(r["passed"] + r["rejected"] for r in counted) == 10

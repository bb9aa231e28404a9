"""Command line: ``python -m tsumugi.cli --input corpus.parquet --output out.parquet --styles ... --answers recorded.parquet``.

With ``--endpoint`` a chat service is asked; its key comes from the environment or an ``.env`` file.
"""

from __future__ import annotations

import argparse
import os
import sys

from tsumugi import schemas
from tsumugi.config import Config
from tsumugi.plans.pipeline import Engine
from tsumugi.session import session, ship
from tsumugi.sources import files
from tsumugi.sources.providers import ChatProvider, ChatService, ReplayProvider


def options(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tsumugi", description="Balance a labelled corpus.")
    p.add_argument("--input", required=True)
    p.add_argument("--output", default="output/augmented.parquet")
    p.add_argument("--folder", help="where rounds are kept; beside the output unless given")
    p.add_argument("--styles", help="style presets")
    p.add_argument("--allowed", help="allowed styles by category")
    p.add_argument("--definitions", default="definitions.parquet")
    p.add_argument("--answers", help="recorded answers")
    p.add_argument("--endpoint", help="chat service that is asked instead")
    p.add_argument("--key", help="its key; better set in the environment, where others can't see it")
    p.add_argument("--key-name", default="CHAT_API_KEY", help="the environment's variable that has the key")
    p.add_argument("--env-file", default=".env", help="lines of NAME=VALUE for variables that aren't set")
    p.add_argument("--tasks", type=int, default=1, help="tasks that call the service")
    p.add_argument("--requests-per-minute", type=float, help="limit of calls over all tasks")
    p.add_argument("--max-tokens", type=int, default=Config.max_tokens)
    p.add_argument("--run-id", help="name of the run, part of each sample's id; kept with its rounds")
    p.add_argument("--target", type=int, default=Config.target)
    p.add_argument("--model", default=Config.model)
    p.add_argument("--temperature", type=float, default=Config.temperature)
    p.add_argument("--batch-size", type=int, default=Config.per_request, help="samples of a request")
    p.add_argument("--concurrency", type=int, default=Config.concurrency)
    p.add_argument("--rounds", type=int, default=Config.max_rounds)
    p.add_argument("--dry-run", action="store_true", help="analyse only")
    return p.parse_args(argv)


def environment(path: str) -> None:
    """Set the variables of an ``.env`` file that the environment lacks; comments, quotes and ``export`` are understood."""
    if not os.path.isfile(path):
        return
    with open(path, encoding="utf-8") as lines:
        for line in lines:
            name, is_set, value = line.strip().removeprefix("export ").partition("=")
            if is_set and not name.startswith("#"):
                os.environ.setdefault(name.strip(), value.strip().strip("'\""))


def main(argv: list[str] | None = None) -> int:
    o = options(argv)
    environment(o.env_file)
    if o.key:
        os.environ[o.key_name] = o.key
    if o.endpoint and not o.dry_run and not os.environ.get(o.key_name):
        print(f"no key: set {o.key_name}", file=sys.stderr)
        return 1
    spark = ship(session())
    try:
        corpus = files.read_corpus(spark, o.input)
        config = Config(target=o.target, model=o.model, temperature=o.temperature, per_request=o.batch_size, concurrency=o.concurrency, max_rounds=o.rounds, max_tokens=o.max_tokens, requests_per_minute=o.requests_per_minute)
        table = lambda path, schema: files.read(spark, path) if path else spark.createDataFrame([], schema)
        engine = Engine(spark, corpus, table(o.styles, schemas.STYLE), table(o.allowed, schemas.ALLOWED_STYLE), files.read_definitions(spark, o.definitions), o.folder or f"{o.output}.rounds", config, o.run_id)
        analysis = engine.analyze()
        analysis.totals.show()
        analysis.length_stats.show()
        analysis.deficits.orderBy("needed", ascending=False).show(10, truncate=False)
        if o.dry_run:
            return 0
        provider = ChatProvider(ChatService(o.endpoint, config, o.key_name).connect, config, o.tasks) if o.endpoint else ReplayProvider(table(o.answers, schemas.ANSWER))
        output = engine.run(provider)
        files.write(output, o.output, "overwrite")
        engine.summary(files.read(spark, o.output)).show(truncate=False)
    except FileNotFoundError as e:
        print(f"not found: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())

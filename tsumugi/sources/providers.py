"""Sources of answers. Answers are written before they are used, as a plan computed again would call the model again."""

from __future__ import annotations

import asyncio
import json
import os
import random
import time
import urllib.request
from collections.abc import Awaitable, Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsumugi import schemas
from tsumugi.config import Config

#: A chat call: messages in, text out.
Chat = Callable[[list[dict]], Awaitable[str | None]]


class Provider(Protocol):
    def answer(self, requests: DataFrame) -> DataFrame:
        """Answers (``schemas.ANSWER``), one for each request."""


class ReplayProvider:
    """Recorded answers, joined by request; an empty answer where none is recorded."""

    def __init__(self, recorded: DataFrame) -> None:
        self.recorded = recorded

    def answer(self, requests: DataFrame) -> DataFrame:
        key = ["category", "style", "round", "batch_idx"]
        found = requests.select(*key).join(self.recorded.select(*key, "content").dropDuplicates(key), key, "left")
        return found.select(*key, "content", F.when(F.col("content").isNull(), "not recorded").alias("error"))


class Pace:
    """Lets calls begin at most ``per_minute`` times a minute, evenly spaced; without a limit at once."""

    def __init__(self, per_minute: float | None) -> None:
        self.gap, self.next = 60 / per_minute if per_minute else 0.0, 0.0

    async def turn(self) -> None:
        now = time.monotonic()
        at = max(now, self.next)
        self.next = at + self.gap
        if at > now:
            await asyncio.sleep(at - now)


async def call(chat: Chat, messages: list[dict], slots: asyncio.Semaphore, config: Config, pace: Pace | None = None) -> tuple[str | None, str | None]:
    """Answer and error of one request. A slot is held for a call only, never while waiting to try again.

    Each attempt waits for its turn and fails after ``config.call_seconds``.
    """
    error = None
    for attempt in range(config.retries):
        if attempt:
            await asyncio.sleep(config.backoff_base**attempt * random.uniform(0.9, 1.1) if config.backoff_base else 0)
        try:
            if pace:
                await pace.turn()
            async with slots:
                content = await asyncio.wait_for(chat(messages), config.call_seconds)
        except Exception as e:  # noqa: BLE001 - any failure of the service is retried
            error = f"{type(e).__name__}: {e}"
            continue
        if content and content.strip() or not config.retry_on_empty:
            return (content or "").strip(), None
        error = "empty answer"
    return None, error


class ChatProvider:
    """Calls a chat service from the tasks; ``connect`` makes the client there, so that keys never enter a plan or a log.

    ``tasks * concurrency`` calls run at once; set ``tasks`` by the service's limit. Each task has its share of
    ``config.requests_per_minute``.
    """

    def __init__(self, connect: Callable[[], Chat], config: Config = Config(), tasks: int = 1) -> None:
        self.connect, self.config, self.tasks = connect, config, tasks

    def answer(self, requests: DataFrame) -> DataFrame:
        connect, config = self.connect, self.config
        share = config.requests_per_minute / self.tasks if config.requests_per_minute else None

        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            chat, pace = connect(), Pace(share)

            async def everything(pdf: pd.DataFrame) -> list:
                slots = asyncio.Semaphore(config.concurrency)
                return await asyncio.gather(*[call(chat, [{"role": m["role"], "content": m["content"]} for m in ms], slots, config, pace) for ms in pdf.messages])

            for pdf in parts:
                done = asyncio.run(everything(pdf))
                yield pdf[["category", "style", "round", "batch_idx"]].assign(content=[c for c, _ in done], error=[e for _, e in done])

        return requests.select("category", "style", "round", "batch_idx", "messages").repartition(self.tasks).mapInPandas(run, schemas.ANSWER)


class ChatService:
    """A chat service over HTTP with the common JSON interface: messages are posted to ``endpoint``/chat/completions.

    The key is read from the environment of the process that calls, under ``key_name``; on a cluster it has to be set for the
    executors. Model, temperature and the other sampling options are those of the configuration.
    """

    def __init__(self, endpoint: str, config: Config = Config(), key_name: str = "CHAT_API_KEY") -> None:
        self.endpoint, self.config, self.key_name = endpoint.rstrip("/"), config, key_name

    def connect(self) -> Chat:
        headers = {"Content-Type": "application/json"}
        if key := os.environ.get(self.key_name):
            headers["Authorization"] = f"Bearer {key}"

        def post(messages: list[dict]) -> str | None:
            body = json.dumps({**self.config.sampling, "messages": messages}).encode()
            with urllib.request.urlopen(urllib.request.Request(f"{self.endpoint}/chat/completions", body, headers), timeout=self.config.call_seconds) as got:
                return json.load(got)["choices"][0]["message"]["content"]

        async def chat(messages: list[dict]) -> str | None:
            return await asyncio.to_thread(post, messages)

        return chat

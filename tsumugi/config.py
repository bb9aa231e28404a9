"""Parameters of a run and their defaults."""

from __future__ import annotations

from dataclasses import dataclass

# The default categories that skip the similarity checks, and the safety patterns by name, in order.
SKIP_CATEGORIES = ("債権譲渡",)
SAFETY_PATTERNS = (("url", r"https?://[^\s]+"), ("postal", r"〒\d{3}-\d{4}"), ("phone", r"電話.*\d{2,4}-\d{2,4}-\d{4}"))


@dataclass(frozen=True)
class Config:
    """All options of the engine. An empty ``skip_categories`` means the default list."""

    target: int = 100
    least_valid: int = 120
    mutual_similarity: float = 0.90
    cosine_limit: float = 0.92
    overlap_limit: float = 0.35
    overlap_gram: int = 4
    tfidf_grams: tuple[int, int] = (2, 3)
    body_range: tuple[int, int] = (120, 600)
    title_range: tuple[int, int] = (10, 50)
    most_styles: int = 5
    least_per_style: int = 5
    per_request: int = 3
    script_share: float = 0.6
    script_range: tuple[int, int] = (0x3000, 0x9FFF)
    terminators: tuple[str, ...] = ("。", ".")
    sentence_range: tuple[float, float] = (10.0, 200.0)
    skip_categories: tuple[str, ...] = ()
    examples_shown: int = 3
    example_chars: int = 200
    max_rounds: int = 1
    concurrency: int = 3
    retries: int = 3
    backoff_base: float = 2.0
    retry_on_empty: bool = False
    model: str = "replay"
    temperature: float = 0.8
    max_tokens: int = 2000
    presence_penalty: float = 0.3
    frequency_penalty: float = 0.2
    #: Calls a minute over all tasks; none means no limit.
    requests_per_minute: float | None = None
    #: Seconds after which a call counts as failed.
    call_seconds: float = 120.0
    #: Categories whose answers are kept together.
    save_interval: int = 10
    seed: int = 42

    @property
    def sampling(self) -> dict:
        """What a call of a chat service is given besides its messages."""
        return {"model": self.model, "temperature": self.temperature, "max_tokens": self.max_tokens, "presence_penalty": self.presence_penalty, "frequency_penalty": self.frequency_penalty}

    @property
    def skipped(self) -> tuple[str, ...]:
        return self.skip_categories or SKIP_CATEGORIES

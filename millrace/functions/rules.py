"""Record rules as data: the first that fails names the bucket, offending values are never shown."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import textops as X

PROFILE_URL = r"^https://www\.linkedin\.com/(in|company)/"
CHANNEL = r"\A[A-Za-z][A-Za-z0-9_]{4,31}\z"
STATES = ("parsed", "scored", "irrelevant", "sent")


@dataclass(frozen=True)
class Rule:
    bucket: str
    fails: Column

    def label(self) -> Column:
        return F.when(F.coalesce(self.fails, F.lit(False)), self.bucket)


def first_failure(rules: list[Rule]) -> Column:
    """The bucket of the first rule that fails, null if none does."""
    return F.coalesce(*(r.label() for r in rules)) if rules else F.lit(None).cast("string")


def text_rules(text: Column, bucket: str = "text") -> list[Rule]:
    return [Rule(bucket, X.is_blank(text)), Rule(bucket, text.startswith("Feed post")), Rule(bucket, ~X.has_letter(text))]


def window_rules(posted: Column, scraped: Column, max_days: int | None) -> list[Rule]:
    out = [Rule("model", posted > scraped)]
    if max_days is not None:
        out.append(Rule("model", scraped - posted > F.make_dt_interval(F.lit(max_days))))
    return out


def extra_keys(keys: Column, known: list[str]) -> Rule:
    return Rule("extra", F.size(F.array_except(keys, F.array(*map(F.lit, known)))) > 0)


MESSAGE_FIELDS = ["channel", "channel_title", "message_id", "text", "posted_at", "scraped_at"]
POST_FIELDS = ["author_profile_url", "author_name", "text", "post_relative_age", "post_time_iso", "scraped_at"]


def post_rules(max_days: int = 30) -> list[Rule]:
    """Of a feed post; times as timestamps that are null where they couldn't be read."""
    c = F.col
    url, age = c("author_profile_url"), c("post_relative_age")
    return [
        Rule("author_profile_url", url.isNull() | ~url.rlike(PROFILE_URL)),
        Rule("author_name", X.is_blank(c("author_name"))),
        *text_rules(c("text")),
        Rule("post_relative_age", age.isNull() | ~age.rlike(r"\A[0-9]{1,2}[mhdw]\z")),
        Rule("post_time_iso", c("post_time_iso").isNull()),
        Rule("scraped_at", c("scraped_at").isNull()),
        *window_rules(c("post_time_iso"), c("scraped_at"), max_days),
    ]


def message_rules() -> list[Rule]:
    """Of a channel message; there is no oldest age."""
    c = F.col
    return [
        Rule("channel", c("channel").isNull() | ~c("channel").rlike(CHANNEL)),
        Rule("message_id", c("message_id").isNull() | (c("message_id") <= 0)),
        Rule("text", X.is_blank(c("text"))),
        Rule("posted_at", c("posted_at").isNull()),
        Rule("scraped_at", c("scraped_at").isNull()),
        *window_rules(c("posted_at"), c("scraped_at"), None),
    ]


def envelope_rules() -> list[Rule]:
    c = F.col
    return [
        Rule("id", c("id").isNull()),
        Rule("platform", c("platform").isNull()),
        Rule("text", c("text").isNull()),
        Rule("status", c("status.state").isNull() | ~c("status.state").isin(*STATES)),
        Rule("feedback", c("feedback").isNotNull() & ~c("feedback").between(0, 10)),
    ]

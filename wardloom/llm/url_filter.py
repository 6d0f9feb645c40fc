"""URL filters: pattern rules indexed by their rarest literal token.

Every rule is a regular expression over ``host || path`` together with the literal tokens that any text it fits must
hold. Each rule is filed under the one of its tokens that the fewest URLs have. A URL looks up its own tokens and runs
only the expressions filed there. The index is a literal in the plan: a URL is judged in one projection, without
Python, joins or shuffles; only the token counts take a pass of their own, and give one number per literal token.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from itertools import product
from zlib import crc32

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters between tokens; hosts count as lower case, paths as they are.
SPLIT = r"[^A-Za-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in host and path; ``tokens`` are literals that every text it fits holds as tokens."""

    name: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    named: bool = False  # takes part in "longest wins" and is named in the result

    def __post_init__(self) -> None:
        if not self.tokens or self.verdict not in ("allow", "block"):
            raise ValueError(f"rule {self.name!r} needs a literal token and a verdict, allow or block")


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for a host, all its subdomains and the paths that start with ``path``."""
    host = host.lower()
    last = re.split(r"[^A-Za-z0-9]", path)[:-1]  # what the pattern cuts off in mid-token is no token
    tokens = [t for t in [*re.split(SPLIT, host), *last] if t]
    return Rule(host + path, rf"^([^/]*\.)?{_quoted(host)}{_quoted(path)}", tuple(dict.fromkeys(tokens)), verdict, True)


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9])", r"\\\1", text)


#: The site rules of the query.
SITE_RULES = (
    site_rule("block", "net", "/"),
    site_rule("allow", "example.net", "/en/"),
    site_rule("block", "example.com", "/de/"),
    site_rule("allow", "org", "/fr/"),
)

#: What decides where no site rule fits. Hosts that sell in two words, the second perhaps in the plural;
#: hosts of two words that stand as they are; starts of paths of two words under which links are dealt in.
SELLING = (("cheap", "free", "best", "online"), ("pill", "bet", "loan", "casino", "replica"))
HOSTS = (
    (("casino", "poker", "slots"), ("win", "bonus", "live")),
    (("ads", "banner", "click"), ("track", "server", "count")),
    (("spam", "link", "seo"), ("farm", "list", "exchange")),
    (("adult", "porn", "xxx"), ("x", "cam", "video")),
)
PATHS = (("buy", "sell", "exchange"), ("links", "backlinks"))
PATTERN_RULES = (
    *(Rule(f"{a}-{b}", rf"^([^/]*\.)?{a}-{b}s?\.", (a,), "block") for a, b in product(*SELLING)),
    *(Rule(f"{a}-{b}.", rf"^([^/]*\.)?{a}-{b}\.", (a, b), "block") for family in HOSTS for a, b in product(*family)),
    *(Rule(f"/{a}-{b}/", rf"^[^/]*/{a}-{b}/", (a, b), "block") for a, b in product(*PATHS)),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path: after the first ``://`` to ``/ ? #``, A-Z in lower case; then to ``? #``. Else both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), upper, lower)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def _tokens(subject: Column) -> Column:
    return F.array_distinct(F.split(subject, SPLIT))


def token_counts(urls: DataFrame, url: str, rules: Sequence[Rule]) -> dict[str, int]:
    """How many URLs hold each literal token of the rules: one row per token reaches the driver."""
    literals = sorted({t for r in rules for t in r.tokens})
    host, path = url_parts(F.col(url))
    rows = (
        urls.select(F.explode(F.array_intersect(_tokens(F.concat(host, path)), F.array(*map(F.lit, literals)))).alias("token"))
        .groupBy("token")
        .count()
    )
    return dict.fromkeys(literals, 0) | {r["token"]: r["count"] for r in rows.collect()}


class RuleIndex:
    """Rules by their rarest token, as a literal array of slots, so that a lookup costs the same for any number of rules."""

    def __init__(self, rules: Iterable[Rule], counts: dict[str, int]):
        self.rules = list(rules)
        self.filed: dict[str, list[Rule]] = {}
        for rule in self.rules:
            self.filed.setdefault(min(rule.tokens, key=lambda t: (counts.get(t, 0), t)), []).append(rule)

    def column(self) -> Column:
        kind = "array<struct<token:string,name:string,pattern:string,verdict:string,named:boolean>>"
        slots: list[list[Column]] = [[] for _ in range(self.slots)]
        for token, rules in self.filed.items():
            for r in rules:
                fields = dict(token=token, name=r.name, pattern=r.pattern, verdict=r.verdict, named=r.named)
                slots[_place(token, self.slots)].append(F.struct(*(F.lit(v).alias(k) for k, v in fields.items())))
        return F.array(*(F.array(*s).cast(kind) if s else F.array().cast(kind) for s in slots))

    @property
    def slots(self) -> int:
        return 1 << max(0, len(self.filed) - 1).bit_length()

    def candidates(self, subject: Column) -> Column:
        """The rules filed under any token of ``subject``."""
        index, slots = self.column(), self.slots

        def fetched(token: Column) -> Column:
            return F.filter(F.element_at(index, _place_of(token, slots) + 1), lambda r: r["token"] == token)

        return F.flatten(F.transform(_tokens(subject), fetched))


def _place_of(token: Column, slots: int) -> Column:
    return (F.crc32(token.cast("binary")) % slots).cast("int")


def _place(token: str, slots: int) -> int:
    return crc32(token.encode()) % slots


def judge(
    pages: DataFrame, key: str = "page_id", url: str = "url", site_rules: Sequence[Rule] = SITE_RULES, pattern_rules: Sequence[Rule] = PATTERN_RULES
) -> DataFrame:
    """key, host, path, rule, verdict and pattern of every row.

    The longest site rule that fits decides and is named in ``rule``. Where none fits, ``rule`` is null; the pattern
    rules decide then, "block" if any blocking one fits and no allowing one does, and "allow" is the rest. ``pattern``
    is the first pattern rule that fits. Null or malformed urls have an empty host and path and are allowed; repeated
    rows are judged one by one, urls of any length as a whole; of site rules of one length the last in code-point order
    decides; an empty table gives an empty one; other columns are not read.
    """
    rules = [*site_rules, *pattern_rules]
    index = RuleIndex(rules, token_counts(pages, url, rules))
    host, path = url_parts(F.col(url))
    parts = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    subject = F.concat("host", "path")
    fits = F.filter(index.candidates(subject), lambda r: F.rlike(subject, r["pattern"]))
    sites = F.filter("fits", lambda r: r["named"])
    best = F.array_max(F.transform(sites, lambda r: F.struct(F.length(r["name"]).alias("length"), r["name"].alias("name"), r["verdict"].alias("verdict"))))
    others = F.filter("fits", lambda r: ~r["named"])
    verdicts = F.transform(others, lambda r: r["verdict"])
    own = F.when(F.array_contains(verdicts, "block") & ~F.array_contains(verdicts, "allow"), "block").otherwise("allow")
    return (
        parts.withColumn("fits", fits)
        .select("key", "host", "path", best.alias("best"), own.alias("own"), F.array_min(F.transform(others, lambda r: r["name"])).alias("pattern"))
        .select(
            F.col("key").alias(key),
            "host",
            "path",
            F.col("best.name").alias("rule"),
            F.coalesce("best.verdict", "own").alias("verdict"),
            "pattern",
        )
    )

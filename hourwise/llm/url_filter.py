"""Operator 8, URL filters: pattern rules indexed by their rarest literal token.

A rule is either a list rule (host and path prefix: it fits the host and all its subdomains, if the URL's path starts
with the rule's) or a pattern rule (regular expression over the whole URL).  Every rule has literal tokens, runs of
``[a-z0-9]`` that any URL it fits must hold; those of a pattern rule are read off its parsed expression.  A token is
whole if the rule also fixes what stands around it, else open (it may be a part of a longer one).  A rule is indexed
under the token that the fewest URLs hold (counted over all URLs in Spark).  A URL's tokens fetch the candidate rules,
whole ones from a dictionary and open ones by one Aho-Corasick pass, and only those are compared or run.  Rules
without a literal token are candidates for every URL.

List rules decide first: the longest (host and path together) wins, then a block, then the smaller rule text.
Otherwise the method's verdict is ``block`` if any pattern rule matches, else ``allow``.

Rules go to the tasks in blocks of at most ``block_rules``; each pass keeps the best rule so far, so the answer does
not depend on the number of passes and what is broadcast stays bounded.

Defined results: null URL or one without ``://`` -> host and path empty, no list rule; pattern rules still see the
text of the URL, a null URL is allowed.  An empty rule table allows everything.  Repeated rows are each judged, a
null id is kept, other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from re import _constants as op
from re import _parser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, stored

#: The list rules (action, host, path prefix).
LIST_RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)

#: The pattern rules (name, regular expression).
PATTERN_RULES = (
    ("ad-path", r"/ads?(?:erver)?s?/"), ("doubleclick", r"://[^/]*doubleclick\."),
    ("casino", r"(?i)\bcasino\b"), ("porn", r"(?i)\bporn"), ("xxx-host", r"(?i)://[^/]*\.xxx(?:[/:?#]|$)"),
    ("click-tracker", r"[?&]utm_[a-z]+="), ("cgi-search", r"/cgi-bin/"),
    ("session", r"(?i)[?&;]phpsessid="), ("tracker-host", r"(?i)://[^/]*\btracker\b"),
    ("second-page", r"[?&]page=[0-9]+&ref="),
)

TOKEN = r"[a-z0-9]+"


def parts(url):
    """Columns host and path of a URL column."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def tokens(c):
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN), 0)


def fixed_text(parsed) -> list[str | None]:
    """The ASCII characters that every match of a parsed expression holds, in order; None stands for anything."""
    out: list[str | None] = []
    for kind, value in parsed:
        if kind is op.LITERAL:
            out.append(chr(value) if value < 128 else None)
        elif kind in (op.SUBPATTERN, op.ATOMIC_GROUP):
            out += fixed_text(value[-1] if kind is op.SUBPATTERN else value)
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT) and value[0]:
            out += [*fixed_text(value[2]), *([] if value[0] == value[1] == 1 else [None])]
        elif kind not in (op.AT, op.ASSERT, op.ASSERT_NOT):  # those take no characters
            out.append(None)
    return out


def literals_of(regex: str) -> list[tuple[str, bool]]:
    """(token, whole) of a pattern rule: tokens that every URL it fits holds, in lower case."""
    text = "".join("\x80" if c is None else c for c in fixed_text(_parser.parse(regex, re.ASCII))).lower()
    around = f"\x80{text}\x80"
    return sorted({(m.group(), "\x80" not in (around[m.start()], around[m.end() + 1])) for m in re.finditer(TOKEN, text)})


def rule_table(spark: SparkSession, list_rules=LIST_RULES, pattern_rules=PATTERN_RULES) -> DataFrame:
    """(kind, name, action, host, path, regex, literals): rules as a table.  The last token of a path prefix may go on
    in the URL (``/en/1`` fits ``/en/15``), so only closed ones count there, all of them whole."""
    rows = [("list", h + p, a, h, p, None, [(t, True) for t in sorted(set(re.findall(TOKEN, h)) | set(re.findall(TOKEN + r"(?=[^a-z0-9])", p.lower())))])
            for a, h, p in list_rules]
    rows += [("pattern", n, "block", None, None, r, literals_of(r)) for n, r in pattern_rules]
    return spark.createDataFrame(rows, "kind string, name string, action string, host string, path string, regex string, literals array<struct<token:string,whole:boolean>>")


def automaton_of(words: dict):
    """Aho-Corasick automaton of the keys, or None."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for word, value in words.items():
        a.add_word(word, value)
    a.make_automaton()
    return a if words else None


def open_counts(seen: DataFrame, wanted: DataFrame, block_rules: int) -> DataFrame:
    """(token, n): how often the URLs' tokens contain each open literal; literals go to the tasks in blocks."""
    spark = seen.sparkSession
    table = stored(wanted.where("NOT whole").select("token").distinct(), "open-literals")
    blocks = -(-table.count() // block_rules) or 1
    out = spark.createDataFrame([], "token string, n long")
    for k in range(blocks):
        own = table.where(F.pmod(F.xxhash64("token"), F.lit(blocks)) == k).orderBy("token").toArrow()["token"].to_pylist()
        if not own:
            continue
        sent = spark.sparkContext.broadcast(own)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            find = automaton_of({t: t for t in sent.value})
            for b in batches:
                n: dict[str, int] = {}
                for token, count in zip(b.column("token").to_pylist(), b.column("n").to_pylist()):
                    for t in {t for _, t in find.iter(token)}:
                        n[t] = n.get(t, 0) + count
                yield pa.RecordBatch.from_arrays([pa.array(n, pa.string()), pa.array(n.values(), pa.int64())], ["token", "n"])

        out = out.unionByName(seen.mapInArrow(run, "token string, n long"))
    return out.groupBy("token").agg(F.sum("n").alias("n"))


def indexed(rules: DataFrame, pages: DataFrame, url: str, block_rules: int = 100_000) -> DataFrame:
    """Rules with ``token`` and ``whole``: the literal that the fewest URLs hold (ties: whole, the smaller; null: none)."""
    seen = pages.select(F.explode(F.array_distinct(tokens(F.col(f"`{url}`")))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    own = ["kind", "name", "action", "host", "path", "regex"]
    wanted = rules.select(*own, F.explode_outer("literals").alias("l")).select(*own, "l.token", "l.whole")
    seen = stored(seen, "url-tokens")
    n = seen.withColumn("whole", F.lit(True)).unionByName(open_counts(seen, wanted, block_rules).withColumn("whole", F.lit(False)))
    counted = wanted.join(n, ["token", "whole"], "left").fillna({"n": 0})
    first = F.min(F.when(F.col("token").isNotNull(), F.struct("n", (~F.col("whole")).alias("open"), "token")))
    return counted.groupBy(*own).agg(first.alias("l")).select(*own, F.col("l.token").alias("token"), (~F.col("l.open")).alias("whole"))


class Index:
    """Candidate rules by token: a dictionary of whole tokens, an automaton of open ones."""

    def __init__(self, rules: list[dict]):
        self.always: list = []
        self.whole: dict[str, list] = {}
        parts: dict[str, list] = {}
        for r in rules:
            r["re"] = re.compile(r["regex"], re.ASCII) if r["regex"] else None
            if r["token"] is None:
                self.always.append(r)
            else:
                (self.whole if r["whole"] else parts).setdefault(r["token"], []).append(r)
        self.open = automaton_of(parts)

    def candidates(self, url: str) -> list:
        low = url.lower()
        out = list(self.always)
        for t in dict.fromkeys(re.findall(TOKEN, low)):
            out += self.whole.get(t, ())
        if self.open is not None:
            for own in {id(own): own for _, own in self.open.iter(low)}.values():
                out += own
        return out

    def judge(self, url: str | None, host: str, path: str, best: tuple, blocked: bool) -> tuple[tuple, bool]:
        """best: (length, action, name) of the best list rule so far, or ()."""
        for r in self.candidates(url) if url is not None else ():
            if r["kind"] == "list":
                h = r["host"]
                if path.startswith(r["path"]) and "://" in url and (host == h or host.endswith("." + h)):
                    new = (-len(r["name"]), r["action"] != "block", r["name"], r["action"])
                    best = min(best, new) if best else new
            elif not blocked:
                blocked = bool(r["re"].search(url))
        return best, blocked


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", block_rules: int = 100_000) -> DataFrame:
    """``pages`` in a struct ``_row``, then ``host``, ``path``, ``rule`` and ``verdict``."""
    spark = pages.sparkSession
    bounded_batches(spark)
    table = stored(indexed(rules, pages, url, block_rules), "rules")
    blocks = -(-table.count() // block_rules) or 1
    host, path = parts(F.col(f"`{url}`"))
    out = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("_row"), F.col(f"`{url}`").alias("_url"),
                       host.alias("host"), path.alias("path"), F.lit(None).cast("string").alias("rule"),
                       F.lit(None).cast("string").alias("action"), F.lit(False).alias("blocked"))
    for k in range(blocks):
        own = table.where(F.pmod(F.xxhash64("kind", "name"), F.lit(blocks)) == k).orderBy("kind", "name").toArrow().to_pylist()
        sent = spark.sparkContext.broadcast(own)
        ready: list[Index] = []

        def run(batches: Iterator[pa.RecordBatch], sent=sent, ready=ready) -> Iterator[pa.RecordBatch]:
            if not ready:
                ready.append(Index([dict(r) for r in sent.value]))
            for b in batches:
                c = {n: b.column(n).to_pylist() for n in ("_url", "host", "path", "rule", "action", "blocked")}
                rule, action, blocked = [], [], []
                for u, h, p, r, a, x in zip(*c.values()):
                    best, hit = ready[0].judge(u, h, p, (-len(r), a != "block", r, a) if r else (), x)
                    rule.append(best[2] if best else None)
                    action.append(best[3] if best else None)
                    blocked.append(hit)
                new = {"rule": pa.array(rule, pa.string()), "action": pa.array(action, pa.string()), "blocked": pa.array(blocked, pa.bool_())}
                yield pa.RecordBatch.from_arrays([new.get(n, b.column(i)) for i, n in enumerate(b.schema.names)], b.schema.names)

        out = out.mapInArrow(run, out.schema)
        out = stored(out, "judged") if k + 1 < blocks else out
    verdict = F.coalesce("action", F.when(F.col("blocked"), "block").otherwise("allow"))
    return out.select("_row", "host", "path", "rule", verdict.alias("verdict"))


def op8_url_filter(spark, sf_dir: str) -> DataFrame:
    from .common import read

    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rule_table(spark)).select("_row.page_id", "host", "path", "rule", "verdict")


def _oracle() -> str:
    rules = ", ".join(f"('{h}{p}', '{a}', '{h}', '{p}')" for a, h, p in LIST_RULES)
    patterns = " OR ".join(f"regexp_matches(coalesce(url, ''), '{r}')" for _, r in PATTERN_RULES)
    return rf"""
WITH rules(rule, action, rule_host, rule_path) AS (VALUES {rules}),
u AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
best AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action FROM p JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN {patterns} THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN best USING (page_id)
"""


ORACLE = _oracle()

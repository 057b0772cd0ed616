"""URL filter: rules first, then a classifier on the words of host and path.

Method: names in hosts are words run together; a unigram Viterbi search splits each into its likeliest words,
with word counts from the pages themselves. Multinomial naive Bayes then scores the words of the host and the
tokens of the path. It learns from the pages that a rule decides, and decides those that no rule fits.

Counts cover all pages. Names are segmented once each, however many pages share them: their substrings are
joined to the word counts. The odds of tokens are a table as well, joined to the tokens of distinct hosts and
paths, so neither the dictionary nor the classifier has to fit anywhere.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: (verdict, host and path start); the longest rule that fits wins.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))

#: The longest name of a host; longer words cannot be part of one.
LONGEST_WORD = 63
_OPEN = re.compile(rb"<(?:script|style)\b")
_CLOSE = re.compile(rb"</(?:script|style)>")
_WORD = re.compile(rb"[a-z]+")


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://``, A-Z lower-cased; path up to ``?`` or ``#``; else both empty."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, text.substr(at + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, text in sorted(rules, key=lambda r: len(r[1])):
        own, slash, start = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, name).otherwise(verdict)
    return rule, verdict


def path_tokens(path: Column) -> Column:
    """Lower-cased words of the path; a number becomes ``#`` and its count of digits."""
    parts = F.regexp_extract_all(F.lower(path), F.lit("([a-z]+|[0-9]+)"), 1)
    return F.transform(parts, lambda t: F.concat(F.lit("/"), F.when(t.rlike("^[0-9]"), F.concat(F.lit("#"), F.length(t).cast("string"))).otherwise(t)))


def names_of(host: Column) -> Column:
    return F.regexp_extract_all(host, F.lit("([a-z]+)"), 1)


def visible(html: bytes) -> bytes:
    """Lower-cased text without tags, scripts and styles, in one forward scan; an unclosed tag is text."""
    low, out, at, closed = html.lower(), [], 0, True
    while (i := low.find(b"<", at)) >= 0:
        end = -1
        if closed and (m := _OPEN.match(low, i)):
            close = _CLOSE.search(low, m.end())
            closed, end = close is not None, close.end() if close else -1
        if end < 0 and not (end := low.find(b">", i) + 1):
            break
        out.append(low[at:i])
        at = end
    return b" ".join([*out, low[at:]])


def count_words(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(word, n) over the visible text of all pages; each task adds up what it has seen before the shuffle."""

    def run(batches):
        def out():
            return pa.RecordBatch.from_arrays([pa.array(tally.keys(), pa.string()), pa.array(tally.values(), pa.int64())], names=["word", "n"])

        tally: Counter[str] = Counter()
        for b in batches:
            for html in b.column(0).to_pylist():
                words = _WORD.findall(visible(html))
                tally.update(w.decode() for w in words if len(w) <= LONGEST_WORD)
                if len(tally) > 200_000:
                    yield out()
                    tally.clear()
        yield out()

    text = F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("html")
    return pages.select(text).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def viterbi(name: str, edges: list[tuple[int, int, int]], total: int) -> list[str]:
    """The likeliest words of a name. edges: (start, length, count) of its substrings that are words.

    An unknown run costs ten times more for each letter; of equal paths the one with the longer last word wins.
    """
    n = len(name)
    log_total = math.log(max(total, 1) + 1)
    best: list[tuple[float, int]] = [(0.0, 0)] + [(-math.inf, 0)] * n
    known: dict[int, list[tuple[int, int]]] = {}
    for start, length, count in edges:
        known.setdefault(start + length, []).append((start, count))
    for end in range(1, n + 1):
        choice = best[end]
        for start in range(max(0, end - LONGEST_WORD), end):
            cost = best[start][0] - log_total - (end - start) * math.log(10)
            if cost > choice[0]:
                choice = (cost, start)
        for start, count in sorted(known.get(end, ())):
            cost = best[start][0] + math.log(count) - log_total
            if cost > choice[0]:
                choice = (cost, start)
        best[end] = choice
    out, end = [], n
    while end:
        start = best[end][1]
        out.append(name[start:end])
        end = start
    return out[::-1]


def segment_names(names: DataFrame, words: DataFrame) -> DataFrame:
    """(name, words array<string>) of distinct names; words: (word, n)."""
    total = words.agg(F.sum("n")).first()[0] or 0
    spots = names.select("name", F.explode(F.sequence(F.lit(0), F.length("name") - 1)).alias("start"))
    room = F.least(F.lit(LONGEST_WORD), F.length("name") - F.col("start"))
    cuts = spots.select("name", "start", F.explode(F.sequence(F.lit(1), room)).alias("length")).withColumn("word", F.col("name").substr(F.col("start") + 1, F.col("length")))
    hits = cuts.join(words, "word").groupBy("name").agg(F.collect_list(F.struct("start", "length", "n")).alias("edges"))

    def run(batches):
        for b in batches:
            rows = [viterbi(name, [(e["start"], e["length"], e["n"]) for e in edges or []], total) for name, edges in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.string()))], names=["name", "words"])

    return names.join(hits, "name", "left").select("name", "edges").mapInArrow(run, "name string, words array<string>")


def host_words(hosts: DataFrame, words: DataFrame) -> DataFrame:
    """(host, words) of distinct hosts; a host without letters has an empty array."""
    parts = hosts.select("host", F.posexplode(names_of(F.col("host"))).alias("pos", "name"))
    split = segment_names(parts.select("name").distinct(), words)
    joined = parts.join(split, "name").groupBy("host").agg(F.array_sort(F.collect_list(F.struct("pos", "words"))).alias("w"))
    flat = joined.select("host", F.flatten(F.col("w.words")).alias("words"))
    return hosts.join(flat, "host", "left").select("host", F.coalesce("words", F.array().cast("array<string>")).alias("words"))


def token_odds(pages: DataFrame, hosts: DataFrame) -> tuple[DataFrame, int]:
    """((token, odds) of every token of decided pages, odds of the prior): allow against block, in units of 1e-9.

    pages: (host, path_tokens, verdict), with null verdicts left out; hosts: (host, words). Multinomial naive Bayes
    with Laplace smoothing by one. Whole units make sums that do not depend on their order.
    """
    decided = pages.where(F.col("verdict").isNotNull()).withColumn("good", (F.col("verdict") == "allow").cast("long"))
    by_host = decided.groupBy("host").agg(F.sum("good").alias("good"), F.count("*").alias("all")).join(hosts, "host")
    of_hosts = by_host.select(F.explode("words").alias("token"), "good", "all")
    of_paths = decided.select(F.explode("path_tokens").alias("token"), "good", F.lit(1).cast("long").alias("all"))
    counts = materialize(of_hosts.unionByName(of_paths).groupBy("token").agg(F.sum("good").alias("good"), (F.sum("all") - F.sum("good")).alias("bad")), "tokens")
    sums = counts.agg(F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.count("*").alias("tokens")).first()
    prior = decided.agg(F.sum("good"), F.count("*")).first()
    good, all_ = prior[0] or 0, prior[1]
    base = math.log(sums["bad"] + sums["tokens"] + 1) - math.log(sums["good"] + sums["tokens"] + 1)
    odds = F.log((F.col("good") + 1) / (F.col("bad") + 1)) + F.lit(base)
    return counts.select("token", units(odds).alias("odds")), round(1e9 * (math.log(good + 1) - math.log(all_ - good + 1)))


def units(odds: Column) -> Column:
    return F.round(odds * 1e9).cast("long")


def sum_odds(tokens: DataFrame, key: str, column: str, odds: DataFrame) -> DataFrame:
    """(key, sum of odds) of distinct keys with an array of tokens; tokens that no decided page has count for nothing."""
    return tokens.select(key, F.explode(column).alias("token")).join(odds, "token").groupBy(key).agg(F.sum("odds").alias(f"{key}_odds"))


def judge_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, host, path, rule, verdict, score, host_words) of every row.

    score is the classifier's probability of ``allow``; without a rule the verdict is ``allow`` from 0.5 on.
    A null url, or one without ``://``, has an empty host and path and no tokens, so the prior decides; no
    decided page makes the prior even. Null html adds no words; a word of more than 63 letters cannot be part of a
    host and is not counted. Repeated rows give repeated results; an empty table gives no rows.
    """
    host, path = url_parts(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    parsed = parsed.select("id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
    words = materialize(count_words(pages, html_col), "words")
    hosts = materialize(host_words(parsed.select("host").distinct(), words), "hosts")
    odds, prior = token_odds(parsed.withColumn("path_tokens", path_tokens(F.col("path"))), hosts)
    of_hosts = sum_odds(hosts, "host", "words", odds)
    of_paths = sum_odds(parsed.select("path").distinct().withColumn("tokens", path_tokens(F.col("path"))), "path", "tokens", odds)
    total = F.lit(prior) + F.coalesce("host_odds", F.lit(0)) + F.coalesce("path_odds", F.lit(0))
    # written out, so that the joins with all rows have two shuffles of their own, of which hot hosts and paths can be split
    by_host = materialize(hosts.join(of_hosts, "host", "left"), "host_odds")
    by_path = materialize(of_paths, "path_odds")
    rows = parsed.join(by_host, "host", "left").join(by_path, "path", "left")
    return rows.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.when(total >= 0, "allow").otherwise("block")).alias("verdict"),
        (1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), total / 1e9))))).alias("score"),
        F.array_join("words", " ").alias("host_words"),
    )

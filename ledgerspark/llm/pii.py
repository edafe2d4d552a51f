"""Personal data: base patterns, plus identifiers found by bootstrapped
contextual extraction.

Base spans come from fixed expressions per kind (``base_spans``).  They are
the seeds.  Other candidates are groups of digits written together (``0171 555
0123`` is one) and words with a digit or an ``@``.  Every seed and candidate
has lexical patterns, taken from the words and punctuation marks next to it
(digits in them count as 0) and from its own shape (runs of letters, digits and
signs, as in ``a9-9``):

* the word before, with the marks between (``token="``), and the shape;
* the two words before;
* the word before and the word after;
* the word after, with the marks between, and the shape.

Spark holds the graph "pattern - instance" and iterates:

* a pattern's confidence for a kind is accepted / (instances + 1), over the
  distinct instances it has anywhere, if at least ``support`` are accepted;
* an instance's score is the probability that not all of its confident
  patterns err (noisy or); at ``accept`` it is accepted as its best kind (of
  equal ones the first) and counts like a seed from then on.

Accepted instances stay, so confidences only grow; the iteration ends when
nothing new is accepted, after as many rounds as the longest chain takes.

Every occurrence of an accepted instance next to one of its confident
patterns becomes a span of that kind.  Base spans are never dropped.

Scores travel through joins and grouped counts over distinct (pattern,
instance) edges; no group is ever gathered in one task.  Null and empty texts
have no spans.  Repeated rows get equal results; null ids are kept.  Other
columns may have any names.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import broadcast_if_small, discard, give_back, ready, row_key, stored, text_of

# fixed values: the base expressions; a kind's number is its place
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_NOT_DIGIT = re.compile(r"[^0-9]")
# candidates: digits with blanks, brackets, dots and hyphens between, or a word
_NUMBER = re.compile(r"[0-9(+][0-9().\x20-]*+")
_WORD = re.compile(r"[A-Za-z0-9_@.%+-]++")
# marks that are a token of their own next to a candidate
_MARKS = frozenset("\"'`()[]{}<>,;:!?=|*#")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of ``local+@domain``, from each @."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and _LOCAL.match(text, begin - 1):
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            out.append((begin, m.end()))
            done = m.end()
        else:
            done = max(done, at)
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all base matches, in order."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    out.sort()
    return out


def _before(text: str, at: int) -> tuple[str, int]:
    """The token that ends before ``at``, and where it begins ("" at the start)."""
    while at and text[at - 1].isspace():
        at -= 1
    end = at
    if at and text[at - 1] in _MARKS:
        return text[at - 1], at - 1
    while at and not text[at - 1].isspace() and text[at - 1] not in _MARKS:
        at -= 1
    return text[at:end], at


def _after(text: str, at: int) -> tuple[str, int]:
    """The token that begins after ``at``, and where it ends ("" at the end)."""
    n = len(text)
    while at < n and text[at].isspace():
        at += 1
    begin = at
    if at < n and text[at] in _MARKS:
        return text[at], at + 1
    while at < n and not text[at].isspace() and text[at] not in _MARKS:
        at += 1
    return text[begin:at], at


def _neighbour(text: str, at: int, step) -> tuple[str, str, int]:
    """The next word with a letter on one side, the marks before it, and where
    it was found; numbers between count as a mark."""
    marks = ""
    while True:
        token, at = step(text, at)
        if not token or any(c.isalpha() for c in token):
            return _DIGITS.sub("0", token.lower()), marks, at
        marks += token if token in _MARKS else "0"


def shape(instance: str) -> str:
    """Runs of letters as a, of digits as 9; signs as they are."""
    return re.sub("9+", "9", re.sub("a+", "a", re.sub("[0-9]", "9", re.sub("[^\\W\\d_]", "a", instance))))


def patterns(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns of text[start:end]."""
    left, left_marks, at = _neighbour(text, start, _before)
    right, right_marks, _ = _neighbour(text, end, _after)
    form = shape(text[start:end])
    out = []
    if left:
        out.append(f"{left}{left_marks[::-1]} _ {form}")
        further = _neighbour(text, at, _before)[0]
        if further:
            out.append(f"{further} {left} _")
        if right:
            out.append(f"{left} _ {right}")
    if right:
        out.append(f"_ {form} {right_marks}{right}")
    return out


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Groups of digits, and words with a digit or @, that no base span touches."""
    found = []
    if _DIGITS.search(text) or "@" in text:
        for m in _NUMBER.finditer(text):
            at = m.start()
            for part in m[0].split("  "):
                a, b = at, at + len(part)
                at = b + 2
                while b > a and not text[b - 1].isdigit():
                    b -= 1
                while a < b and not (text[a].isdigit() or text[a] in "(+"):
                    a += 1
                if any(c.isdigit() for c in text[a:b]):
                    found.append((a, b))
        for m in _WORD.finditer(text):
            word = m[0].rstrip(".-+%")
            if any(c.isalpha() for c in word) and ("@" in word or any(c.isdigit() for c in word)):
                found.append((m.start(), m.start() + len(word)))
    # a word wins over digits inside it; both give way to base spans
    found.sort(key=lambda x: (x[0], -x[1]))
    out: list[tuple[int, int]] = []
    done, k, reach = 0, 0, 0
    for a, b in found:
        while k < len(taken) and taken[k][0] < b:
            reach = max(reach, taken[k][2])
            k += 1
        if a >= done and reach <= a:
            out.append((a, b))
            done = b
    return out


SEEN = "array<struct<start:long,end:long,kind:int,instance:long,patterns:array<long>>>"


def _number(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def found_spans(docs: DataFrame) -> DataFrame:
    """rid, doc_id, base: array of (start, kind, end), seen: array of (start,
    end, kind or -1, and as 64-bit numbers instance and patterns)."""
    ready()
    source = docs.select(
        row_key().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")
    )
    schema = f"rid long, doc_id long, base array<struct<start:long,kind:int,end:long>>, seen {SEEN}"

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            base, seen = [], []
            for text in batch["text"]:
                spans = base_spans(text)
                words = [(a, b, k) for a, k, b in spans] + [(a, b, -1) for a, b in candidates(text, spans)]
                base.append([{"start": a, "kind": k, "end": b} for a, k, b in spans])
                seen.append(
                    [
                        {
                            "start": a,
                            "end": b,
                            "kind": k,
                            "instance": _number(text[a:b].lower()),
                            "patterns": sorted({_number(p) for p in patterns(text, a, b)}),
                        }
                        for a, b, k in words
                    ]
                )
            out = pd.DataFrame({"rid": batch["rid"], "doc_id": batch["doc_id"].astype("Int64")})
            out["base"], out["seen"] = base, seen
            yield out
        give_back()

    return source.mapInPandas(find, schema)


def discovered(found: DataFrame, support: int = 3, accept: float = 0.8, confidence: float = 0.5) -> DataFrame:
    """rid, start, kind, end of the identifiers that the graph accepts.

    ``found``: the stored result of ``found_spans``.
    """
    seen = found.select("rid", F.explode("seen").alias("s")).select("rid", "s.*")
    all_edges = seen.select("instance", F.explode("patterns").alias("pattern")).distinct()
    sizes = stored(
        all_edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= support), "pii-sizes"
    )
    edges = stored(all_edges.join(broadcast_if_small(sizes), "pattern"), "pii-edges")
    # an instance that is a seed of several kinds counts for each
    seeds = stored(seen.where("kind >= 0").select("instance", "kind").distinct(), "pii-seeds")
    accepted, old = seeds, None
    while True:
        sure = (
            edges.join(broadcast_if_small(accepted), "instance")
            .groupBy("pattern", "kind")
            .agg(F.count(F.lit(1)).alias("accepted"), F.first("n").alias("n"))
            .withColumn("p", F.col("accepted") / (F.col("n") + 1))
            .where((F.col("accepted") >= support) & (F.col("p") >= confidence))
            .select("pattern", "kind", "p")
        )
        sure = stored(sure, "pii-patterns")
        if sure.isEmpty():
            break
        best = Window.partitionBy("instance").orderBy(F.col("score").desc(), "kind")
        new = (
            edges.join(broadcast_if_small(sure), "pattern")
            .join(broadcast_if_small(accepted.select("instance").distinct()), "instance", "left_anti")
            .groupBy("instance", "kind")
            .agg((1 - F.exp(F.sum(F.log1p(-F.col("p"))))).alias("score"))
            .where(F.col("score") >= accept)
            .withColumn("place", F.row_number().over(best))  # at most one row for each kind
            .where("place = 1")
            .select("instance", "kind")
        )
        new = stored(new, "pii-new")
        if new.isEmpty():
            break
        accepted = stored(accepted.union(new), "pii-accepted")
        if old is not None:
            discard(old)
        old = accepted
    unseeded = accepted.join(broadcast_if_small(seeds.select("instance").distinct()), "instance", "left_anti")
    if unseeded.isEmpty():
        return seen.select("rid", "start", "kind", "end").where(F.lit(False))
    unseeded = stored(unseeded.withColumnRenamed("kind", "to"), "pii-discovered")
    return (
        seen.where("kind < 0")
        .select("rid", "start", "end", "instance", "patterns")
        .join(broadcast_if_small(unseeded), "instance")
        .withColumn("pattern", F.explode("patterns"))
        .join(broadcast_if_small(sure).withColumnRenamed("kind", "to"), ["pattern", "to"])
        .select("rid", "start", F.col("to").alias("kind"), "end")
        .distinct()
    )


def _collected(extra: DataFrame) -> DataFrame:
    entry = F.struct("start", "kind", "end")
    return extra.groupBy(F.col("rid").alias("extra_rid")).agg(F.collect_set(entry).alias("extra"))


def _listed(spans: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(
        f"array_join(transform({spans}, x -> concat_ws(':', element_at(array({names}), x.kind + 1), x.start, x.end)), ',')"
    )


def personal_data(docs: DataFrame, **graph) -> DataFrame:
    """Per row: doc_id, base and spans (arrays of start, kind, end), n_email,
    n_ip, n_card, n_phone (base matches), base_list and spans_list (text)."""
    found = stored(found_spans(docs), "pii-found")
    extra = stored(_collected(discovered(found, **graph)), "pii-extra")
    both = found.select("rid", "doc_id", "base").join(broadcast_if_small(extra), F.col("rid") == F.col("extra_rid"), "left")
    none = F.expr("cast(array() AS array<struct<start:bigint,kind:int,end:bigint>>)")
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = {k})) AS bigint)").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    spans = both.withColumn("spans", F.array_sort(F.concat("base", F.coalesce("extra", none))))
    return spans.select("doc_id", "base", "spans", *counts, _listed("base").alias("base_list"), _listed("spans").alias("spans_list"))


def redact(docs: DataFrame, **graph) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; n_chars (if
    there) is the new length.  Overlapping spans are replaced as one."""
    ready()
    found = stored(found_spans(docs), "pii-found")
    extra = stored(_collected(discovered(found, **graph)), "pii-extra")

    def replaced(text: str | None, more) -> str | None:
        if text is None:
            return None
        spans = base_spans(text)
        if more is not None and len(more):
            spans = sorted(spans + [(x["start"], x["kind"], x["end"]) for x in more])
        parts, done = [], 0
        for a, k, b in spans:
            if a >= done:
                parts += [text[done:a], f"[{KINDS[k].upper()}]"]
            done = max(done, b)
        return "".join(parts) + text[done:] if spans else text

    @F.pandas_udf("string")
    def cleaned(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, extras in batches:
            yield pd.Series([replaced(t, x) for t, x in zip(texts, extras, strict=True)], dtype=object)
        give_back()

    # the row as one column: its own column names cannot clash with ours
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("row"), row_key().alias("rid"))
    joined = rows.join(broadcast_if_small(extra), F.col("rid") == F.col("extra_rid"), "left")
    joined = joined.withColumn("cleaned", cleaned(F.col("row").getField("text").cast("string"), F.col("extra")))
    row = F.col("row").withField("text", F.col("cleaned"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.char_length("cleaned").cast(docs.schema["n_chars"].dataType))
    return joined.select(row.alias("row")).select("row.*")

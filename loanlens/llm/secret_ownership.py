"""Secrets in texts, told apart by who else has them.

Candidates are found by patterns.  Their hashes are counted over the whole corpus by
distinct repositories and owners: a value that many owners hold, or that went through many
repositories of a few, was copied from an example; one that stays with its holder looks like
a live credential.  The base patterns are reported either way; further patterns, which match
much that is harmless, add a span only for values that look live.

Positions are code points.  Matches are bracketed inside the text by two control
characters, so that their places follow from the lengths of the pieces between brackets:
a running sum, taken in blocks so that it grows with the number of matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.session import materialised

OPEN, CLOSE, OTHER = "\x01", "\x02", "\x03"

# Kinds in their order, pattern, and the group whose length counts with its minimum.
BASE: dict[str, tuple[str, int, int]] = {
    "assign": (
        "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6,
    ),
    # A match of these two runs to the end of its characters, so the length can be asked for in the pattern.
    "access": ("AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": ("[0-9a-f]{24,}", 0, 24),
}
# Further kinds: public prefixes of issued tokens, passwords in addresses, key blocks.
MORE: dict[str, tuple[str, int, int]] = {
    "issued": ("(?:gh[pousr]_|xox[abprs]-|sk-|AIza|glpat-)[A-Za-z0-9_-]+", 0, 24),
    "signed": ("eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]*", 0, 30),
    "login": ("[a-z][a-z0-9+.-]*://[^\\s/:@]+:([^\\s/:@]+)@", 1, 6),
    "block": ("-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\\s]*", 0, 64),
}
KINDS = [*BASE, *MORE]
# A value held by more owners, or in more repositories, than this was copied, not issued to its holder.
MOST_OWNERS = 2
MOST_REPOSITORIES = 4
# Numbers of a running sum that are added up at a time.
SUM_BLOCK = 256


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sum(numbers: Column) -> Column:
    """The sums of an array of long numbers up to each of its elements."""
    def after(start: Column, block: Column) -> Column:
        sums = F.aggregate(block, F.array(start), lambda a, x: F.array_append(a, F.element_at(a, -1) + x))
        return F.slice(sums, F.lit(2), F.size(block))

    def of_blocks(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda a, x: a + x))
        starts = F.aggregate(totals, F.array(F.lit(0).cast("long")), lambda a, x: F.array_append(a, F.element_at(a, -1) + x))
        return F.flatten(F.zip_with(blocks, F.slice(starts, F.lit(1), F.size(blocks)), lambda b, start: after(start, b)))

    def of_numbers(n: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.greatest(F.floor((F.size(n) - 1) / SUM_BLOCK).cast("int"), F.lit(0)))
        return _let(F.transform(blocks, lambda b: F.slice(n, b * SUM_BLOCK + 1, F.lit(SUM_BLOCK))), of_blocks)

    return _let(numbers, of_numbers)


def _matches(text: Column, kind: str) -> Column:
    """Spans (start, end, kind, value) of one kind; leftmost, non-overlapping, short ones dropped.

    ``text`` must be free of the brackets.  ``value`` is the part that is the secret.
    """
    pattern, group, least = (BASE | MORE)[kind]
    def of_pieces(pieces: Column) -> Column:
        # Every piece but the first holds the end of its bracket, which is no part of the text.
        ends = running_sum(F.transform(pieces, lambda p, i: (F.length(p) - F.when(i == 0, 0).otherwise(1)).cast("long")))
        return F.zip_with(F.slice(pieces, F.lit(2), F.size(pieces)), F.slice(ends, F.lit(1), F.size(pieces) - 1), span)

    def span(piece: Column, at: Column) -> Column:
        own = F.substring_index(piece, CLOSE, 1)
        return F.struct(at.alias("start"), (at + F.length(own)).alias("end"), own.alias("text"))

    spans = _let(F.split(F.regexp_replace(text, pattern, f"{OPEN}$0{CLOSE}"), OPEN), of_pieces)
    value = lambda s: F.regexp_extract(s["text"], pattern, group) if group else s["text"]
    named = F.transform(spans, lambda s: F.struct(s["start"], s["end"], F.lit(KINDS.index(kind)).alias("kind"), value(s).alias("value")))
    return F.filter(named, lambda s: F.length(s["value"]) >= least)


def _found(text: Column, kinds: list[str]) -> Column:
    """All spans of the kinds by start, then kind.  Texts in which a kind cannot occur cost one search."""
    none = F.array().cast("array<struct<start:bigint,end:bigint,kind:int,value:string>>")
    found = [F.when(text.rlike((BASE | MORE)[k][0]), _matches(text, k)).otherwise(none) for k in kinds]
    return F.array_sort(F.flatten(F.array(*found)))


def _shown(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.concat_ws(",", F.transform(spans, one))


def candidates(docs: DataFrame, owner: str, repository: Column) -> DataFrame:
    """One row per document with its spans; values are replaced by hashes."""
    # The brackets are other control characters where a text has them; lengths stay.
    clean = F.regexp_replace(F.coalesce("text", F.lit("")), f"[{OPEN}{CLOSE}]", OTHER)
    found = docs.select("doc_id", F.col(owner).alias("owner"), repository.alias("repository"), _found(clean, KINDS).alias("s"))
    hashed = F.transform("s", lambda s: F.struct(s["start"], s["end"], s["kind"], F.sha2(s["value"], 256).alias("hash")))
    return found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repository", hashed.alias("spans"))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, owners, repositories): how many distinct ones hold each value; null counts as one of them.

    Holders are made distinct before they are counted, so a value with a third of all rows
    is summed in its map tasks.
    """
    each = found.select("owner", "repository", F.explode("spans").alias("s")).select("s.hash", "owner", "repository").distinct()
    by_owner = each.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repositories"))


def scan(
    docs: DataFrame, owner: str = "source", repository: Column | None = None, most_owners: int = MOST_OWNERS,
    most_repositories: int = MOST_REPOSITORIES,
) -> DataFrame:
    """One row per document with its secrets.

    doc_id, n_assign, n_access, n_hex, base_sha256 and spans as the base patterns and the
    ownership decide, n_live (spans whose value stays with ``most_owners`` owners and
    ``most_repositories`` repositories or fewer), n_copied (the others), live_spans, and
    holders: owners/repositories of each span's value, in the order of ``spans``.  A repository is one language of an owner unless
    given.  Null text counts as empty; null owners and repositories are one of each; repeated
    rows each count their spans, but not as further owners.  Other columns are ignored.
    An empty table gives an empty result.
    """
    if repository is None:
        repository = F.struct("source", "lang")
    found = materialised(candidates(docs, owner, repository), "secrets")
    spans = found.filter(F.size("spans") > 0).select("row", F.explode("spans").alias("s"))
    spans = spans.select("row", "s.*").join(ownership(found), "hash")
    live = (F.col("owners") <= most_owners) & (F.col("repositories") <= most_repositories)
    span = F.struct("start", "end", "kind", live.alias("live"), "owners", "repositories")
    kept = spans.filter(live | (F.col("kind") < len(BASE)))
    by_row = kept.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("all"))
    rows = found.select("row", "doc_id").join(by_row, "row", "left")
    every = F.coalesce("all", F.array().cast("array<struct<start:bigint,end:bigint,kind:int,live:boolean,owners:bigint,repositories:bigint>>"))
    rows = rows.select("doc_id", every.alias("all"))
    n = lambda test: F.size(F.filter("all", test)).cast("long")
    of = lambda kind: n(lambda s: s["kind"] == KINDS.index(kind))
    return rows.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(_shown(F.filter("all", lambda s: s["kind"] < len(BASE))), 256).alias("base_sha256"),
        _shown(F.col("all")).alias("spans"),
        n(lambda s: s["live"]).alias("n_live"),
        n(lambda s: ~s["live"]).alias("n_copied"),
        _shown(F.filter("all", lambda s: s["live"])).alias("live_spans"),
        F.concat_ws(",", F.transform("all", lambda s: F.concat_ws("/", s["owners"].cast("string"), s["repositories"].cast("string")))).alias("holders"),
    )

"""Document fingerprints from closed syncmers.

A text's tokens are its words up to `WHOLE` characters; longer runs without white space are cut behind
any of `CUTS`, and every character from U+0E00 on (scripts that write no spaces, and symbols) is a token
of its own, so that no token depends on how far away its run begins. Each run of `K` tokens
is a k-mer, each run of `S` tokens inside it an inner substring with a hash. A k-mer is a closed
syncmer if the smallest of its inner hashes is at its first or last place. Whether it is one
depends on its own tokens alone, not on the text around it, so that an edit changes only the
syncmers that it touches: the chosen k-mers are context-free anchors, and their token positions
line two texts up.

The fingerprint of a text is all its anchors in order: for each its distance in tokens from the one
before, one hexadecimal digit (`K` - `S` at most, the first counted from 0), and eight digits of hash.
It grows with the text; nothing is sampled. `matches` pairs equal anchors of two texts, the first
of each hash on either side, by one sort. The likeness of two texts is the number of matches over
that of distinct anchors in both, `in_line` the most matches at one offset: the length, in
anchors, of what the texts have in common in the same order.

All of it is built-in functions. Scale: for neighbours, documents are dealt into buckets of
equal counts by cuts of doc_id, once, each with the first row of the next bucket; a document
meets the next one in a window inside its bucket. Only texts cross the network; anchors are found
where they are matched. Their work is sorting, n log n in a text's length.

Cases: a null text is empty; an empty text, or one of white space, has an empty fingerprint; a
text of fewer than `K` tokens has one k-mer, all its tokens; two empty fingerprints have likeness
1, an empty and another one 0. Documents are ordered by doc_id, null first, then by a hash of
the text and the text; repeated rows follow one another. A single document is its own next one.
An empty table gives an empty table; extra columns are ignored.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from callscope.llm.common import read_table, shuffle_partitions
from callscope.llm.registry import register

K = 5
S = 2
WHOLE = 16
#: A long run is cut behind these and behind anything that is no letter or digit: one character in six or so.
CUTS = "ae05KR"

_SPACE = "\\x20\\x09-\\x0D"
_ALONE = "\\x{0E00}-\\x{10FFFF}"
_INSIDE = f"(?:(?![{CUTS}])[\\p{{L}}\\p{{M}}\\p{{N}}&&[^{_ALONE}]])"
#: A short word as a whole, a character of its own, or a piece of a long run up to its cut.
TOKEN = (
    f"(?<![^{_SPACE}{_ALONE}])[^{_SPACE}{_ALONE}]{{1,{WHOLE}}}+(?![^{_SPACE}{_ALONE}])"
    f"|[{_ALONE}]|{_INSIDE}++[^{_SPACE}{_ALONE}]?+|[^{_SPACE}{_ALONE}]"
)
#: Tokens of the text `t`, and of token hashes `a` the hashes of pairs (S = 2).
_TOKENS = f"transform(regexp_extract_all({{text}}, r'{TOKEN.replace('{', '{{').replace('}', '}}')}', 0), t -> hash(t))"
_PAIRS = "zip_with(slice(a, 1, size(a) - 1), slice(a, 2, size(a) - 1), (x, y) -> hash(x, y))"
#: Places whose k-mer is chosen: of its four inner hashes an outer one is the smallest.
_PLACES = "filter(sequence(0, size(s) - 4), i -> least(s[i], s[i + 3]) <= least(s[i + 1], s[i + 2]))"
#: A k-mer of five tokens is told by its first, third and fourth pair.
_KMER = "hash(s[i], s[i + 2], s[i + 3]) & 2147483647"


def _let(name: str, value: str, body: str) -> str:
    """`body` with `value` bound to `name`, evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _of_tokens(text: str, each: str, whole: str, none: str) -> Column:
    """`each` over the chosen places, `whole` for texts shorter than a k-mer, `none` for empty ones."""
    chosen = _let("s", _PAIRS, f"transform({_PLACES}, i -> {each})")
    body = f"CASE WHEN size(a) = 0 THEN {none} WHEN size(a) < {K} THEN {whole} ELSE {chosen} END"
    return F.expr(_let("a", _TOKENS.format(text=f"coalesce({text}, '')"), body))


def anchors(text: str) -> Column:
    """array<struct<at, hash>>: token position and hash of each closed syncmer of a column."""
    return _of_tokens(
        text, f"named_struct('at', i, 'hash', {_KMER})", "array(named_struct('at', 0, 'hash', hash(a) & 2147483647))", "array()"
    ).cast("array<struct<at:int,hash:int>>")


def fingerprint(anchored: Column) -> Column:
    """The anchors as one string: distance from the anchor before, and hash."""
    def written(x: Column, i: Column) -> Column:
        gap = x["at"] - F.when(i > 0, F.get(anchored, i - 1)["at"]).otherwise(0)
        return F.concat(F.hex(gap), F.lpad(F.hex(x["hash"]), 8, "0"))

    return F.lower(F.array_join(F.transform(anchored, written), ""))


def matches(left: Column, right: Column) -> Column:
    """array<struct<left, right, hash>>: token positions of the anchors that two texts share, each anchor's first."""
    # In one order by hash, a left anchor's first place comes last of the left ones, next to the first of the right ones.
    both = F.concat(
        F.transform(left, lambda x: F.struct(x["hash"].alias("hash"), F.lit(0).alias("side"), (-x["at"]).alias("at"))),
        F.transform(right, lambda x: F.struct(x["hash"].alias("hash"), F.lit(1).alias("side"), x["at"].alias("at"))),
    )

    def paired(u: Column) -> Column:
        n = F.size(u) - 1
        neighbours = F.zip_with(F.slice(u, F.lit(1), n), F.slice(u, F.lit(2), n), lambda x, y: F.when(
            (x["hash"] == y["hash"]) & (x["side"] < y["side"]), F.struct((-x["at"]).alias("left"), y["at"].alias("right"), x["hash"].alias("hash"))))
        return F.when(n > 0, F.filter(neighbours, lambda m: m.isNotNull())).otherwise(F.array().cast("array<struct<left:int,right:int,hash:int>>"))

    return F.transform(F.array(F.array_sort(both)), paired)[0]


def likeness(left: Column, right: Column, matched: Column) -> Column:
    """0 to 1 for two texts' anchors and their matches: common anchors over distinct ones of both."""
    every = F.size(F.array_union(F.transform(left, lambda x: x["hash"]), F.transform(right, lambda x: x["hash"])))
    return F.when(every > 0, F.size(matched) / every).otherwise(F.lit(1.0))


def in_line(matched: Column) -> Column:
    """The most matches at one offset between the two texts."""
    def step(state: Column, offset: Column) -> Column:
        run = F.when(offset == state["offset"], state["run"] + 1).otherwise(1)
        return F.struct(offset.alias("offset"), run.alias("run"), F.greatest(state["best"], run).alias("best"))

    first = F.struct(F.lit(None).cast("int").alias("offset"), F.lit(0).alias("run"), F.lit(0).alias("best"))
    offsets = F.array_sort(F.transform(matched, lambda m: m["right"] - m["left"]))
    return F.aggregate(offsets, first, step, lambda s: s["best"])


def with_next(docs: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """`docs` with `next_<c>` for each of `columns`: the value of the row that follows, after the last the first.

    `order` are columns of `docs`; the first is a number, by whose cuts the rows are dealt out.
    """
    spark = docs.sparkSession
    buckets = 3 * shuffle_partitions(spark)
    key = order[0]
    shares = F.array(*[F.lit((i + 1) / buckets) for i in range(buckets - 1)])
    found = docs.agg(F.percentile_approx(key, shares, F.lit(20 * buckets)).alias("cuts"), F.min(key).alias("low"), F.count(F.when(F.col(key).isNull(), 1)).alias("nulls")).first()
    # Every cut is a value of the column and begins a bucket; the smallest value is no cut, unless nulls come before it.
    cuts = sorted({c for c in found.cuts or [] if found.nulls or c > found.low})
    last = len(cuts)
    edges = F.array(*[F.lit(c) for c in cuts]).cast("array<long>")
    bucket = F.when(F.col(key).isNull(), 0).otherwise(F.size(F.filter(edges, lambda c: c <= F.col(key))))
    # The rows that may come first in a bucket are also seen, as guests, at the end of the bucket before.
    first = F.col(key).isNull() if found.nulls else F.col(key) == F.lit(found.low)
    opens = F.when(F.coalesce(first, F.lit(False)), last).when(F.array_contains(edges, F.col(key)), bucket - 1)
    copies = F.when(opens.isNull(), F.array(F.struct(bucket.alias("bucket"), F.lit(False).alias("guest")))).otherwise(
        F.array(F.struct(bucket.alias("bucket"), F.lit(False).alias("guest")), F.struct(opens.alias("bucket"), F.lit(True).alias("guest")))
    )
    placed = docs.select("*", F.inline(copies))
    along = W.partitionBy("bucket").orderBy("guest", *[F.col(c).asc_nulls_first() for c in order])
    following = placed.select("*", *[F.lead(c).over(along).alias(f"next_{c}") for c in columns])
    return following.filter("NOT guest").drop("bucket", "guest")


@register("op3_closed_syncmers")
def op3_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    paired = with_next(docs.withColumn("text_hash", F.xxhash64("text")), ["text"], ["doc_id", "text_hash", "text"])
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = paired.select(
        "doc_id", n.cast("long").alias("n_chars"), "text", "next_text",
        F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter)).alias("edited"),
    )

    def of(own: Column, changed: Column, following: Column) -> Column:
        with_edited, with_following = matches(own, changed), matches(own, following)
        pair = F.struct(with_edited.alias("edited"), with_following.alias("following"))
        return F.transform(F.array(pair), lambda m: F.struct(
            fingerprint(own).alias("fingerprint"), fingerprint(changed).alias("edited_fingerprint"),
            likeness(own, changed, m["edited"]).alias("near_edited"), likeness(own, following, m["following"]).alias("near_next"),
            in_line(m["edited"]).alias("line_edited"), in_line(m["following"]).alias("line_next"),
        ))[0]

    # Bound by a lambda, so that each text's anchors are found once.
    three = F.struct(anchors("text").alias("own"), anchors("edited").alias("edited"), anchors("next_text").alias("following"))
    judged = F.transform(F.array(three), lambda x: of(x["own"], x["edited"], x["following"]))
    return edited.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.inline(judged))

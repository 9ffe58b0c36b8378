"""Personal data: generators propose spans, boosted trees choose among them.

Base spans are what four patterns find, leftmost and non-overlapping for each kind, if they pass
their check (parts of an ip, Luhn for a card, digits of a phone). They always stay. On top of
them, generators of high recall propose spans that may overlap: addresses with other characters
or written out, card and phone numbers next to more digits, phones without a plus. Each proposal
has small features of its format and context.

Learning: a match of a whole base pattern is labelled by its check, which is no feature, and each
match that passes is also labelled 0 at the place `AWAY` characters before it: the same format in
another context. The trees are fitted by Newton steps on those, in half of the documents, so that they
tell contexts and formats of real data from others, and score all proposals. In the other
half, each kind gets the lowest threshold at which the labelled proposals above it reach
`PRECISION`; a kind that never reaches it adds nothing. A proposal is added if it passes its
kind's check and its threshold and overlaps neither a base span nor a better proposal.

All work on texts is built-in functions. Since features are small numbers, Spark reduces the
proposals of all documents to counts by feature pattern, at most `MAX_PATTERNS`, and the trees are
fitted on those counts; they come back as one column expression. Both halves are counted
whole, so that a rare kind is learned and calibrated at any size. No rows are shuffled but counts.

Cases: a null text is empty; without labelled proposals only base spans are returned; repeated
rows are judged alike; equal scores prefer the earlier, then the longer span; an empty table
gives an empty table. Positions, overlaps with base spans and runs of overlapping proposals come from
running sums and maxima in blocks, so that a text of very many spans takes little more than linear
time; only proposals that overlap one another in a chain are compared among themselves. Repetitions in patterns are possessive, so that very long texts neither
overflow the stack nor are searched twice. Extra columns are ignored by the query and stay in `redact`.
"""

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope.llm.common import read_table, spare_name
from callscope.llm.registry import register

KINDS = ("email", "ip", "card", "phone")
MAX_PATTERNS = 100_000
PRECISION = 0.95
ROUNDS = 12
RATE = 0.5
#: Weight that pulls leaves towards zero.
RIDGE = 1.0
#: What a match that fails its check counts as a negative: of numbers that are no card one in ten
#: passes Luhn's check, so each that fails stands for a ninth of one that passes. By kind.
CHANCE = (1.0, 1.0, 1 / 9, 1.0)
#: Characters of context before a span, and how far a labelled span is moved to be a negative one.
CONTEXT = 20
AWAY = 20

_LOCAL = r"[A-Za-z0-9._%+-]"
_CHAIN = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])"
#: Fixed patterns of the base spans. Look-behinds and possessive forms do not change what they
#: find: a match starts where its run of characters does, or where the last match ended.
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": _CHAIN,
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PLAIN = r"[^\s@<>()\[\]{}\"',;:]"
GENERATORS = {
    "email": (
        rf"(?:\G|(?<!{_PLAIN})){_PLAIN}++@{_PLAIN}++",
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(]\x20?(?i:at)\x20?[\])]\x20?[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20?[\[(]\x20?(?i:dot)\x20?[\])]\x20?)[A-Za-z0-9-]{1,63}+)++",
    ),
    "ip": (r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])",),
    "card": (
        _CHAIN,
        r"(?<![0-9])[0-9]{4}([\x20.-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])",
    ),
    "phone": (
        r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])",
        r"(?<![0-9+(.-])(?<![0-9+][\x20.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9]|[\x20.-][0-9])",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    ),
}
#: What a text must hold for a pattern to be searched.
_NEEDS = {"email": r"@|[\[(]\x20?(?i:at)\x20?[\])]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]{2}|[0-9][\x20.-][0-9]", "phone": r"[0-9]{3}[\x20.-]?[0-9]{3}|\+[0-9]"}
#: One cheap test for all of them: most texts end here.
_ANY = r"[0-9@\[(]"
_KEYWORDS = {
    "email": r"e-?mail|mail|contact|addr", "ip": r"\bip|addr|server|host",
    "card": r"card|visa|credit|pay", "phone": r"tel|phone|call|fax|mobile|contact",
}
_NEAR = r"[^0-9@]{0,12}$"

_SPAN = "array<struct<start:int,end:int,value:string,left:string,right:string>>"
FEATURES = ("kind", "digits", "marks", "plus", "brackets", "keyword", "left", "right", "groups")


def _let(value: Column, body) -> Column:
    """`body` of `value`, which is evaluated once."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, merge) -> Column:
    """Running merges of an array<int> (sums or maxima of numbers from 0 on), in blocks of its size's root.

    Appending to an array copies it, so one walk over all values would take quadratic time.
    """
    none = F.array().cast("array<int>")

    def walked(xs: Column) -> Column:
        def step(state: Column, x: Column) -> Column:
            return _let(merge(state["at"], x), lambda m: F.struct(m.alias("at"), F.concat(state["out"], F.array(m)).alias("out")))

        return F.aggregate(xs, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda s: s["out"])

    def joined(blocks: Column) -> Column:
        upto = walked(F.transform(blocks, lambda b: b[F.size(b) - 1]))
        before = _let(upto, lambda u: F.concat(F.array(F.lit(0)), F.slice(u, F.lit(1), F.size(u) - 1)))
        return F.flatten(F.zip_with(blocks, before, lambda b, c: F.transform(b, lambda x: merge(c, x))))

    def cut(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v))).cast("int")
        return _let(F.transform(F.sequence(F.lit(0), F.size(v) - 1, width), lambda i: walked(F.slice(v, i + 1, width))), joined)

    return _let(values, lambda v: F.when(F.size(v) > 0, cut(v)).otherwise(none))


def found(text: Column, pattern: str, needs: str, context: int = CONTEXT) -> Column:
    """array<struct<start, end, value, left, right>>: leftmost matches and the text around them."""

    def placed(parts: Column) -> Column:
        hits, gaps = parts["hits"], parts["gaps"]
        lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, h: F.char_length(g) + F.char_length(h))

        def at(ends: Column) -> Column:
            return F.transform(F.sequence(F.lit(0), F.size(hits) - 1), lambda i: F.struct(
                (ends[i] - F.char_length(hits[i])).alias("start"), ends[i].alias("end"), hits[i].alias("value"),
                F.right(gaps[i], F.lit(context)).alias("left"), F.left(gaps[i + 1], F.lit(2)).alias("right"),
            ))

        return F.when(F.size(hits) > 0, _let(running(lengths, lambda a, b: a + b), at)).otherwise(F.array().cast(_SPAN))

    parts = F.struct(F.regexp_extract_all(text, F.lit(pattern), 0).alias("hits"), F.split(text, pattern, -1).alias("gaps"))
    return F.when(text.rlike(needs), _let(parts, placed)).otherwise(F.array().cast(_SPAN))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)

    def worth(i: Column) -> Column:
        digit = F.substring(turned, i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + worth(i)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return value.rlike(r"[@)\]].+?[.)\]]\x20?[\p{L}0-9-]{2,}$")
    if kind == "ip":
        parts = F.split(value, r"\.")
        return F.forall(parts, lambda p: _let(F.regexp_replace(p, "^0+(?=.)", ""), lambda q: (F.length(q) <= 3) & (F.substring(q, 1, 3).cast("int") <= 255)))
    if kind == "card":
        return _let(_digits(value), lambda d: F.length(d).between(13, 19) & _luhn(d))
    return F.length(_digits(value)).between(9, 15)


def base_spans(text: Column) -> Column:
    """array<struct<kind, start, end>> in order of kind and start; kind is a place in KINDS."""
    def of(place: int, kind: str) -> Column:
        hits = found(text, BASE[kind], _NEEDS[kind])
        if kind != "email":
            hits = F.filter(hits, lambda h: _valid(kind, h["value"]))
        return F.transform(hits, lambda h: F.struct(F.lit(place).alias("kind"), h["start"].alias("start"), h["end"].alias("end")))

    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    return F.when(text.rlike(_ANY), F.concat(*[of(place, kind) for place, kind in enumerate(KINDS)])).otherwise(none)


def _edge(near: Column) -> Column:
    """0: nothing or white space, 1: punctuation, 2: a letter or digit."""
    return F.when((near == "") | near.rlike(r"^\s$"), 0).when(near.rlike(r"^[\p{L}\p{N}]$"), 2).otherwise(1)


def _keyword(kind: str, left: Column) -> Column:
    """2: a word of this kind shortly before, 1: one of another kind, 0: none."""
    anything = "|".join(_KEYWORDS.values())
    return F.when(~left.rlike(f"(?i)(?:{anything}){_NEAR}"), 0).when(left.rlike(f"(?i)(?:{_KEYWORDS[kind]}){_NEAR}"), 2).otherwise(1)


def _context(kind: str, left: Column, right: Column) -> list[Column]:
    return [_keyword(kind, left).alias("keyword"), _edge(F.right(left, F.lit(1))).alias("left"), _edge(F.left(right, F.lit(1))).alias("right")]


def proposals(text: Column, moved: bool = False) -> Column:
    """array<struct<start, end, label, valid, features...>>; label 1 or 0 by the base check, -1 without.

    With `moved` each one that is labelled 1 comes a second time, labelled 0, in the context `AWAY`
    characters before it, if the text reaches that far.
    """
    def described(place: int, kind: str, h: Column, negative: bool) -> Column:
        value, left, right = h["value"], h["left"], h["right"]
        label = F.when(~value.rlike(f"^(?:{BASE[kind]})$"), -1).otherwise(_valid(kind, value).cast("int"))
        if negative:
            left, right = F.left(left, F.char_length(left) - AWAY), F.right(left, F.lit(AWAY))
            label = F.lit(0)
        elif moved:
            left = F.right(left, F.lit(CONTEXT))
        return F.struct(
            h["start"].alias("start"), h["end"].alias("end"), label.alias("label"), _valid(kind, value).cast("int").alias("valid"),
            F.lit(place).alias("kind"),
            F.least(F.length(_digits(value)), F.lit(24)).alias("digits"),
            F.least(F.length(F.regexp_replace(value, r"[\p{L}\p{N}]", "")), F.lit(9)).alias("marks"),
            value.startswith("+").cast("int").alias("plus"),
            value.rlike(r"[()\[\]]").cast("int").alias("brackets"),
            *_context(kind, left, right),
            F.least(F.size(F.regexp_extract_all(value, F.lit("[0-9]+"), 0)), F.lit(9)).alias("groups"),
        )

    def of(place: int, kind: str, pattern: str) -> Column:
        hits = found(text, pattern, _NEEDS[kind], CONTEXT + AWAY if moved else CONTEXT)
        every = F.transform(hits, lambda h: described(place, kind, h, False))
        if not moved:
            return every
        far = F.filter(hits, lambda h: (F.char_length(h["left"]) > AWAY) & h["value"].rlike(f"^(?:{BASE[kind]})$") & _valid(kind, h["value"]))
        return F.concat(every, F.transform(far, lambda h: described(place, kind, h, True)))

    each = F.array_sort(F.concat(*[of(place, kind, p) for place, kind in enumerate(KINDS) for p in GENERATORS[kind]]))
    # Equal proposals of two generators are neighbours now.
    every = _let(each, lambda a: F.filter(a, lambda p, i: F.when(i == 0, True).otherwise(p != F.get(a, i - 1))))
    fields = ",".join(f"{f}:int" for f in ("start", "end", "label", "valid", *FEATURES))
    return F.when(text.rlike(_ANY), every).otherwise(F.array().cast(f"array<struct<{fields}>>"))


# --- boosted trees on counts by pattern ------------------------------------------------------------


def fit_trees(patterns: list[tuple[tuple[int, ...], int, float]], rounds: int = ROUNDS) -> list[tuple]:
    """Trees of depth two from (features, positive, negative) counts; leaves are numbers.

    A tree is a leaf or (feature, cut, left, right): left where the feature is at most the cut.
    """
    margins = [0.0] * len(patterns)
    trees: list[tuple] = []
    for _ in range(rounds):
        sums = []
        for (_, yes, no), m in zip(patterns, margins, strict=True):
            p = 1 / (1 + math.exp(-m))
            sums.append((yes - (yes + no) * p, (yes + no) * p * (1 - p)))
        tree = _grow(patterns, sums, list(range(len(patterns))), 2)
        trees.append(tree)
        margins = [m + _leaf(tree, f) for m, (f, _, _) in zip(margins, patterns, strict=True)]
    return trees


def _grow(patterns: list, sums: list, rows: list[int], depth: int):
    g, h = sum(sums[i][0] for i in rows), sum(sums[i][1] for i in rows)
    best, gain = None, 1e-9
    for f in range(len(FEATURES)) if depth else ():
        by_value: dict[int, list[float]] = {}
        for i in rows:
            held = by_value.setdefault(patterns[i][0][f], [0.0, 0.0])
            held[0] += sums[i][0]
            held[1] += sums[i][1]
        left_g = left_h = 0.0
        for cut in sorted(by_value)[:-1]:
            left_g += by_value[cut][0]
            left_h += by_value[cut][1]
            more = left_g**2 / (left_h + RIDGE) + (g - left_g) ** 2 / (h - left_h + RIDGE) - g**2 / (h + RIDGE)
            if more > gain:
                best, gain = (f, cut), more
    if best is None:
        return RATE * g / (h + RIDGE)
    f, cut = best
    sides = [i for i in rows if patterns[i][0][f] <= cut], [i for i in rows if patterns[i][0][f] > cut]
    return (f, cut, _grow(patterns, sums, sides[0], depth - 1), _grow(patterns, sums, sides[1], depth - 1))


def _leaf(tree, features: tuple[int, ...]) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return tree


def margin(trees: list, features: tuple[int, ...]) -> float:
    total = 0.0  # added one by one as in `_margin_column`; sum() rounds otherwise
    for t in trees:
        total += _leaf(t, features)
    return total


def _margin_column(trees: list, proposal: Column) -> Column:
    def of(tree) -> Column:
        if not isinstance(tree, tuple):
            return F.lit(float(tree))
        return F.when(proposal[FEATURES[tree[0]]] <= tree[1], of(tree[2])).otherwise(of(tree[3]))

    total = F.lit(0.0)
    for tree in trees:
        total = total + of(tree)
    return total


def thresholds(trees: list, patterns: list[tuple[tuple[int, ...], int, float]], precision: float = PRECISION) -> list[float]:
    """For each kind the lowest margin above which labelled proposals are precise enough."""
    out = []
    for kind in range(len(KINDS)):
        scored = sorted(((margin(trees, f), yes, no) for f, yes, no in patterns if f[0] == kind), reverse=True)
        least, yes, no = math.inf, 0, 0
        for at, (m, y, n) in enumerate(scored):
            yes, no = yes + y, no + n
            last_of_ties = at + 1 == len(scored) or scored[at + 1][0] < m
            if last_of_ties and m > 0 and yes >= precision * (yes + no) and yes:
                least = m
        out.append(least)
    return out


def train(docs: DataFrame) -> tuple[list, list[float]]:
    """Trees from one half of the documents (doc_id, text), thresholds from the other."""
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(2))
    labelled = docs.select(fold.alias("fold"), F.explode(proposals(F.coalesce("text", F.lit("")), moved=True)).alias("p")).filter("p.label >= 0")
    counted = labelled.groupBy("fold", *[F.col(f"p.{f}").alias(f) for f in ("valid", *FEATURES)]).agg(
        F.sum("p.label").alias("yes"), F.sum(1 - F.col("p.label")).alias("no")
    ).limit(MAX_PATTERNS + 1).collect()
    if len(counted) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} feature patterns")

    def patterns(rows: list) -> list[tuple[tuple[int, ...], int, float]]:
        return sorted((tuple(r[f] for f in FEATURES), r.yes, r.no if r.valid else r.no * CHANCE[r.kind]) for r in rows)

    fitted = patterns([r for r in counted if r.fold == 0])
    # Spans that fail their check are never added, so only those that pass count for the precision.
    held_out = patterns([r for r in counted if r.fold == 1 and r.valid == 1])
    trees = fit_trees(fitted) if fitted else []
    return trees, thresholds(trees, held_out)


# --- spans -----------------------------------------------------------------------------------------


def added_spans(proposed: Column, base: Column, trees: list, least: list[float]) -> Column:
    """array<struct<kind, start, end>>: proposals that pass and overlap nothing better."""
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    if not trees or all(math.isinf(x) for x in least):
        return none
    limits = F.array(*[F.lit(float(x)) for x in least])
    scored = F.transform(
        F.filter(proposed, lambda p: p["valid"] == 1),
        lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), (-_margin_column(trees, p)).alias("cost"), p["kind"].alias("kind")),
    )
    passed = F.filter(scored, lambda p: -p["cost"] >= limits[p["kind"]])

    def clear(spans: Column) -> Column:
        """Spans that overlap no base span: none that starts before their end reaches beyond their start."""
        ends = F.transform(spans, lambda p: F.struct(p["end"].alias("at"), F.lit(0).alias("reach"), p["start"].alias("start"), p["cost"].alias("cost"), p["kind"].alias("kind")))
        starts = F.transform(base, lambda b: F.struct(b["start"].alias("at"), b["end"].alias("reach"), F.lit(-1).alias("start"), F.lit(0.0).alias("cost"), F.lit(-1).alias("kind")))

        def free(both: Column) -> Column:
            return _let(running(F.transform(both, lambda x: x["reach"]), F.greatest), lambda reach: F.filter(both, lambda x, i: (x["kind"] >= 0) & (reach[i] <= x["start"])))

        # At one place the ends (reach 0) come before the starts.
        held = _let(F.array_sort(F.concat(ends, starts)), free)
        return F.transform(held, lambda x: F.struct(x["start"].alias("start"), x["at"].alias("end"), x["cost"].alias("cost"), x["kind"].alias("kind")))

    def take(kept: Column, p: Column) -> Column:
        hit = F.exists(kept, lambda k: (k["start"] < -p["minus_end"]) & (p["start"] < k["end"]))
        one = F.struct(p["kind"].alias("kind"), p["start"].alias("start"), (-p["minus_end"]).alias("end"))
        return F.when(hit, kept).otherwise(F.concat(kept, F.array(one)))

    def best(chain: Column) -> Column:
        ranked = F.array_sort(F.transform(chain, lambda p: F.struct(p["cost"].alias("cost"), p["start"].alias("start"), (-p["end"]).alias("minus_end"), p["kind"].alias("kind"))))
        return F.aggregate(ranked, none, take)

    def chosen(spans: Column) -> Column:
        """The best of each chain of overlapping spans; a chain ends where no earlier span reaches."""
        def split(reach: Column) -> Column:
            opens = F.filter(F.sequence(F.lit(0), F.size(spans) - 1), lambda i: F.when(i == 0, True).otherwise(spans[i]["start"] >= F.get(reach, i - 1)))
            return _let(opens, lambda o: F.flatten(F.transform(o, lambda at, k: best(F.slice(spans, at + 1, F.coalesce(F.get(o, k + 1), F.size(spans)) - at)))))

        return F.when(F.size(spans) > 0, _let(running(F.transform(spans, lambda p: p["end"]), F.greatest), split)).otherwise(none)

    return _let(passed, lambda p: F.when(F.size(p) == 0, none).otherwise(_let(F.array_sort(clear(p)), chosen)))


def listed(spans: Column) -> Column:
    """kind:start:end of spans in order, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def detect(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """`docs` with two columns of spans, base ones and all of them, and the columns' names."""
    trees, least = train(docs.select("doc_id", "text"))
    base, every = spare_name(docs, "base_spans"), spare_name(docs, "all_spans")
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = docs.withColumn(base, base_spans(text))
    added = added_spans(proposals(text), F.col(base), trees, least)
    return marked.withColumn(every, F.array_sort(F.concat(F.col(base), added))), base, every


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with every span of `text` replaced by its kind in brackets; overlapping spans are one."""
    found_in, base, every = detect(docs)
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    by_start = F.array_sort(F.transform(F.col(every), lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus_end"), s["kind"].alias("kind"))))

    def step(state: Column, s: Column) -> Column:
        inside = s["start"] < state["at"]
        gap = F.substring(F.col("text"), state["at"] + 1, s["start"] - state["at"])
        text = F.when(inside, state["text"]).otherwise(F.concat(state["text"], gap, names[s["kind"]]))
        return F.struct(F.greatest(state["at"], -s["minus_end"]).alias("at"), text.alias("text"))

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    text = F.aggregate(by_start, first, step, lambda s: F.concat(s["text"], F.substring(F.col("text"), s["at"] + 1, F.char_length("text"))))
    return found_in.withColumn("text", F.when(F.size(every) > 0, text).otherwise(F.col("text"))).select(*docs.columns)


@register("op8_personal_data")
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    marked, base, every = detect(docs)

    def of(place: int) -> Column:
        return F.size(F.filter(F.col(base), lambda s: s["kind"] == place)).cast("long")

    counts = [of(place).alias(f"n_{kind}") for place, kind in enumerate(KINDS)]
    return marked.select("doc_id", *counts, F.sha2(listed(F.col(base)), 256).alias("base_sha256"), listed(F.col(every)).alias("spans"))

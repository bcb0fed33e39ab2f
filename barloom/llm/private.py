"""Personal data: plain patterns find the base, generators propose more spans, boosted trees score them, calibrated thresholds choose."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import durable, forget

KINDS = ("email", "ip", "card", "phone")
#: The base. Each finds what the same pattern without possessive marks and look-behinds finds, in linear time on any text.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators: anything around an at sign, and groups of digits with up to four marks between them that hold seven digits or four parts.
LOOSE_EMAIL = r"(?<![^\s@])[^\s@]++@[^\s@]++"
ZONE = r"(?<![0-9])(?=[0-9]++\.[0-9]++\.[0-9]++\.[0-9]|[0-9](?:[ ().-]{0,4}+[0-9]){6})[0-9]++(?:[ ().-]{1,4}+[0-9]++)*+"
#: Most groups of digits in a proposed span, and features of a span, each a whole number from 0 to 15.
MOST_GROUPS, FEATURES, TOP = 7, 12, 15
#: Boosting: rounds, step, ridge, least rows of a leaf; shares of the fold that calibrates; raw scores are millionths.
ROUNDS, RATE, RIDGE, LEAST_LEAF, UNIT = 8, 0.5, 1.0, 5, 1_000_000
#: Calibrated probability, that a span is like those of the base, from which on it passes, and spans that must pass in the calibration fold.
PRECISION, LEAST_PASSED = 0.9, 20
CONTEXTS = (r"tel|phone|call|fax|mob|handy", r"card|visa|master|amex|konto|tarjeta|carte", r"\bip\b|host|addr|server|mail|contact")


def _found(text: Column, pattern: str, kind: int) -> dict[str, Column]:
    return {f"__p{kind}": F.split(text, pattern, -1), f"__m{kind}": F.regexp_extract_all(text, F.lit(pattern), F.lit(0))}


def _items(kind: int) -> Column:
    """Matches of a pattern with the text between them: (kind, no, skip, match, before, after)."""
    pieces = F.col(f"__p{kind}")
    return F.transform(
        F.col(f"__m{kind}"),
        lambda m, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("no"), F.length(F.element_at(pieces, i + 1)).cast("long").alias("skip"), m.alias("match"),
            F.right(F.element_at(pieces, i + 1), F.lit(16)).alias("before"), F.left(F.element_at(pieces, i + 2), F.lit(4)).alias("after"),
        ),
    )


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _sum_of_digits(s: Column) -> Column:
    return F.when(F.length(s) > 0, F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), lambda a, i: a + F.substring(s, i, F.lit(1)).cast("int"))).otherwise(0)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check: from the right, every second digit is doubled and its digits are added."""
    back = F.reverse(digits)
    plain, doubled = F.regexp_replace(back, "(.)(.?)", "$1"), F.translate(F.regexp_replace(back, "(.)(.?)", "$2"), "0123456789", "0246813579")
    return (_sum_of_digits(plain) + _sum_of_digits(doubled)) % 10 == 0


def _part(s: Column) -> Column:
    """A part of an address as a number; what exceeds 9999 is cut, which is over 255 anyhow."""
    return F.substring(F.regexp_replace(s, "^0+(?=.)", ""), 1, 4).cast("int")


def _valid(kind: Column, match: Column) -> Column:
    digits = _digits(match)
    size = F.length(digits)
    return (
        F.when(kind == 0, True)
        .when(kind == 1, F.forall(F.split(match, r"\."), lambda p: _part(p) <= 255))
        .when(kind == 2, F.when(size.between(16, 19), luhn(digits)).otherwise(False))
        .otherwise(size.between(8, 15))
    )


def _spaced(found: DataFrame) -> DataFrame:
    """Exploded items with the place of each in its text; a row of `found` is one partition of the window."""
    rows = found.select("__row", "fold", F.explode("items").alias("i")).select("__row", "fold", "i.*").repartition("__row")
    order = Window.partitionBy("__row", "kind").orderBy("no")
    return rows.withColumn("start", F.sum(F.col("skip") + F.length("match")).over(order) - F.length("match")).drop("skip")


def _bounded(value: Column) -> Column:
    return F.least(F.greatest(F.coalesce(value, F.lit(0)).cast("int"), F.lit(0)), F.lit(TOP))


def _beside(c: Column) -> Column:
    """What stands next to a span: nothing or white space, a mark of a sentence, a letter, a digit, at or slash, an opening mark, another mark."""
    return (
        F.when(c.rlike(r"^\s?$"), 0).when(c.rlike(r"^[,;:!?.]$"), 1).when(c.rlike(r"^\p{L}$"), 2).when(c.rlike("^[0-9]$"), 3)
        .when(c.rlike("^[@/\\\\=_%]$"), 4).when(c.rlike(r"^[+(\[<{\"']$"), 5).otherwise(6)
    )


def _context(before: Column) -> Column:
    low = F.lower(before)
    return F.when(low.rlike(CONTEXTS[0]), 1).when(low.rlike(CONTEXTS[1]), 2).when(low.rlike(CONTEXTS[2]), 3).otherwise(0)


def _features(*values: Column) -> Column:
    assert len(values) == FEATURES
    return F.array(*[_bounded(v) for v in values])


def _email_candidates(spaced: DataFrame) -> DataFrame:
    """Tokens around an at sign without the marks at their ends, and what follows the last mark before the name."""
    edge = r"[<>()\[\]{}\"',;:!?.*`]+"
    led = F.regexp_replace("match", f"^{edge}", "")
    whole = F.regexp_replace(led, f"{edge}$", "")
    rows = spaced.where("kind = 5").withColumns({"led": F.length("match") - F.length(led), "whole": whole})
    short = F.regexp_replace("whole", r"^[^@]*[:=/;,<(\"'\[]", "")
    rows = rows.select("*", F.explode(F.array_distinct(F.array("whole", short))).alias("span")).where(F.col("span").contains("@"))
    rows = rows.withColumn("lead", F.col("led") + F.length("whole") - F.length("span"))
    local, domain = F.split_part("span", F.lit("@"), F.lit(1)), F.split_part("span", F.lit("@"), F.lit(2))
    around = F.concat("before", F.col("match"), "after")
    at = F.length("before") + F.col("lead")
    previous, following = F.substring(around, at, F.lit(1)), F.substring(around, at + F.length("span") + 1, F.lit(1))
    last = F.element_at(F.split(domain, r"\."), -1)
    features = _features(
        F.length(local), F.length(domain) / 2, F.size(F.split(domain, r"\.")) - 1, F.length(last), F.length(F.regexp_replace(local, "[A-Za-z0-9._%+-]", "")),
        F.length(F.regexp_replace(domain, "[A-Za-z0-9.-]", "")), F.length(_digits(local)), _beside(F.when(at > 0, previous).otherwise("")), _beside(following),
        F.size(F.split(local, r"\.")) - 1, F.when(last.rlike("^[A-Za-z]+$"), 1).when(last.rlike("^[0-9]+$"), 2).otherwise(0), _context(F.col("before")),
    )
    start = F.col("start") + F.col("lead")
    form = F.col("span").rlike(r"^[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++$")
    return rows.select("__row", "fold", F.lit(0).alias("kind"), start.alias("start"), (start + F.length("span")).alias("end"), features.alias("f"), form.alias("form"))


def _number_candidates(spaced: DataFrame) -> DataFrame:
    """Runs of up to MOST_GROUPS neighbouring groups of digits, as address, card or phone number by their digits and separators."""
    zones = spaced.where("kind = 4").withColumns({"gaps": F.split("match", "[0-9]+", -1), "groups": F.regexp_extract_all("match", F.lit("[0-9]+"), F.lit(0))})
    each = F.transform(
        "groups",
        lambda g, k: F.struct(
            k.alias("k"), F.when(k == 0, F.col("before")).otherwise(F.element_at("gaps", k + 1)).alias("gap"),
            F.when(k == 0, 0).otherwise(F.length(F.element_at("gaps", k + 1))).alias("skip"), F.left(g, F.lit(20)).alias("g"), F.length(g).alias("size"),
        ),
    )
    groups = zones.select("__row", "fold", "no", "start", F.right("before", F.lit(16)).alias("words"), "after", F.explode(each).alias("e"))
    groups = groups.select("__row", "fold", "no", "start", "words", "after", "e.*")
    order = Window.partitionBy("__row", "no").orderBy("k")
    groups = groups.withColumn("start", F.col("start") + F.sum(F.col("skip") + F.col("size")).over(order) - F.col("size"))
    ahead = order.rowsBetween(0, MOST_GROUPS)
    runs = groups.withColumn("run", F.collect_list(F.struct("gap", "g", "size", "start")).over(ahead))
    total = lambda m: F.aggregate(F.slice("run", 1, m), F.lit(0), lambda a, x: a + x["size"])
    lengths = F.filter(F.sequence(F.lit(1), F.least(F.size("run"), F.lit(MOST_GROUPS))), lambda m: total(m).between(4, 19))
    runs = runs.select("__row", "fold", "run", "k", "words", "after", F.explode(lengths).alias("m"))
    parts = F.slice("run", 1, F.col("m"))
    runs = runs.withColumns({
        "digits": F.array_join(F.transform(parts, lambda x: x["g"]), ""), "sizes": F.transform(parts, lambda x: x["size"]),
        "inner": F.array_join(F.transform(F.slice("run", 2, F.greatest(F.col("m") - 1, F.lit(0))), lambda x: x["gap"]), "|"),
        "previous": F.element_at("run", 1)["gap"], "end": F.element_at("run", F.col("m"))["start"] + F.element_at("run", F.col("m"))["size"],
        "top": F.array_max(F.transform(parts, lambda x: _part(x["g"]))), "start": F.element_at("run", 1)["start"],
        "following": F.coalesce(F.try_element_at("run", F.col("m") + 1)["gap"], F.col("after")), "joined": F.size("run") > F.col("m"),
    })
    size = F.length("digits")
    sign = F.when(F.col("previous").endswith("+("), 2).when(F.col("previous").rlike(r"[+(]$"), 1).otherwise(0)
    kinds = F.array_compact(F.array(
        F.when((F.col("m") == 4) & (F.col("inner") == ".|.|."), F.struct(F.lit(1).alias("kind"), F.lit(0).alias("sign"))),
        F.when(size.between(13, 19) & F.col("inner").rlike(r"^([ .-](\|[ .-])*)?$"), F.struct(F.lit(2).alias("kind"), F.lit(0).alias("sign"))),
        F.when(size.between(7, 15), F.struct(F.lit(3).alias("kind"), sign.alias("sign"))),
    ))
    runs = runs.withColumn("c", F.explode(kinds)).withColumns({"kind": F.col("c.kind"), "sign": F.col("c.sign"), "luhn": F.when(size.between(13, 19), luhn(F.col("digits")))})
    marks = F.regexp_replace("inner", r"\|", "")
    separators = (
        F.when(F.length(marks) == 0, 0).when(marks.rlike("^ +$"), 1).when(marks.rlike("^-+$"), 2).when(marks.rlike(r"^\.+$"), 3)
        .when(marks.rlike(r"^ \(?[^()]*\)? ?[^()]*$") & marks.contains("("), 4).when(marks.contains("("), 5).otherwise(6)
    )
    before = F.right("previous", F.lit(1))
    signed = F.when(F.col("sign") > 0, F.when(F.col("previous").rlike(r"\+\(?$"), 2).otherwise(1)).otherwise(0)
    features = _features(
        size - 4, F.col("m"), separators, F.when(F.col("luhn"), 1).otherwise(0), F.when(F.col("top") > 255, 2).when(F.col("top") > 199, 1).otherwise(0), signed,
        _beside(before), _beside(F.left("following", F.lit(1))), F.when(F.col("joined"), 1).otherwise(0) + F.when(F.col("k") > 0, 2).otherwise(0),
        F.element_at("sizes", 1), F.element_at("sizes", -1), _context(F.col("words")),
    )
    form = (
        F.when(F.col("kind") == 1, F.col("top") <= 255).when(F.col("kind") == 2, (size >= 16) & F.col("luhn") & ~F.col("inner").contains("."))
        .otherwise((size >= 8) & F.col("previous").endswith("+"))
    )
    return runs.select("__row", "fold", "kind", (F.col("start") - F.col("sign")).alias("start"), "end", features.alias("f"), form.alias("form"))


def _overlaps(spans: DataFrame) -> DataFrame:
    """Marks what shares a character with a base span, of its own kind (same) or of any kind (any)."""
    up, down = (Window.partitionBy("__row").orderBy(o).rangeBetween(Window.unboundedPreceding, 0) for o in (F.col("start"), F.col("start").desc()))
    same, every = [], []
    for kind in range(len(KINDS)):
        held = F.col("base") & (F.col("kind") == kind)
        hit = (F.max(F.when(held, F.col("end"))).over(up) > F.col("start")) | (F.min(F.when(held, F.col("start"))).over(down) < F.col("end"))
        every.append(F.coalesce(hit, F.lit(False)))
        same.append((F.col("kind") == kind) & every[-1])
    either = lambda xs: xs[0] | xs[1] | xs[2] | xs[3]
    return spans.withColumns({"same": either(same), "any": either(every)})


@dataclass
class Boosted:
    """For each kind its trees (feature, cut, then for either side (feature, cut, leaf, leaf) or a leaf) and its threshold, all in millionths."""

    trees: dict[int, list] = field(default_factory=dict)
    thresholds: dict[int, int] = field(default_factory=dict)
    first: dict[int, int] = field(default_factory=dict)

    @staticmethod
    def _low(node) -> Column:
        return F.element_at("f", node[0] + 1) <= node[1]

    def _side(self, side) -> Column:
        return F.lit(side) if isinstance(side, int) else F.when(self._low(side), side[2]).otherwise(side[3])

    def raw(self) -> Column:
        """Log odds of a span in millionths; null for kinds that nothing was learnt of."""
        out = F.lit(None).cast("long")
        for kind, trees in self.trees.items():
            score = F.lit(self.first[kind]).cast("long")
            for tree in trees:
                score = score + F.when(self._low(tree), self._side(tree[2])).otherwise(self._side(tree[3]))
            out = F.when(F.col("kind") == kind, score).otherwise(out)
        return out

    def passes(self, raw: str) -> Column:
        out = F.lit(False)
        for kind, least in self.thresholds.items():
            out = F.when(F.col("kind") == kind, F.col(raw) >= least).otherwise(out)
        return out


def _split(cells: dict[tuple[int, int], tuple[float, float, int]]) -> tuple | None:
    """Best (gain, feature, cut) of sums (gradient, curvature, rows) by feature and value; ties take the first."""
    best = None
    for feature in range(FEATURES):
        row = sorted((v, s) for (x, v), s in cells.items() if x == feature)
        g, h, n = (sum(s[k] for _, s in row) for k in range(3))
        lg = lh = ln = 0
        for value, (dg, dh, dn) in row[:-1]:
            lg, lh, ln = lg + dg, lh + dh, ln + dn
            if min(ln, n - ln) < LEAST_LEAF:
                continue
            gain = lg * lg / (lh + RIDGE) + (g - lg) ** 2 / (h - lh + RIDGE) - g * g / (h + RIDGE)
            if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                best = (gain, feature, value, -lg / (lh + RIDGE), -(g - lg) / (h - lh + RIDGE))
    return best


def fit(table: DataFrame, rounds: int = ROUNDS, precision: float = PRECISION, least_passed: int = LEAST_PASSED) -> Boosted:
    """Boosted trees of two levels from a table (kind, f, fold, label, n) of distinct feature vectors with their numbers of spans.

    Each level of each round is one aggregation to sums by kind, side, feature and value, 16 values at most; only these come to
    the driver, and they are whole numbers, so that reruns agree. Fold 3 isn't learnt from: isotonic regression of its labels on the scores
    gives each score a probability, and a kind's threshold is the least score of `precision`. A kind that learnt no tree, or of whose spans in
    that fold fewer than least_passed pass, passes nothing.
    """
    model = Boosted()
    learnt = table.where("fold <> 3")
    for r in learnt.groupBy("kind").agg(F.sum(F.col("n") * F.col("label")).alias("yes"), F.sum("n").alias("n")).collect():
        if 0 < r["yes"] < r["n"]:
            import math

            model.trees[r["kind"]] = []
            model.first[r["kind"]] = round(UNIT * math.log(r["yes"] / (r["n"] - r["yes"])))
    if not model.trees:
        return model

    def sums(side: Column) -> dict[tuple[int, int], dict]:
        p = 1 / (1 + F.exp(-model.raw() / UNIT))
        rows = learnt.where(F.col("kind").isin(*model.trees)).select("kind", side.alias("side"), "n", F.posexplode("f").alias("x", "v"), (F.round((p - F.col("label")) * UNIT) * F.col("n")).cast("long").alias("g"), (F.round(p * (1 - p) * UNIT) * F.col("n")).cast("long").alias("h"))
        out: dict[tuple[int, int], dict] = {}
        for r in rows.groupBy("kind", "side", "x", "v").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")).collect():
            out.setdefault((r["kind"], r["side"]), {})[r["x"], r["v"]] = (r["g"] / UNIT, r["h"] / UNIT, r["n"])
        return out

    step = lambda value: round(RATE * UNIT * value)
    for _ in range(rounds):
        tops = {kind: found for (kind, _), cells in sums(F.lit(0)).items() if (found := _split(cells))}
        if not tops:
            break
        side = F.lit(None).cast("int")
        for kind, (_, feature, cut, *_) in tops.items():
            side = F.when(F.col("kind") == kind, F.when(F.element_at("f", feature + 1) <= cut, 0).otherwise(1)).otherwise(side)
        cells = sums(side)
        for kind, (_, feature, cut, *leaves) in tops.items():
            sides = []
            for k in range(2):
                found = _split(cells.get((kind, k), {}))
                sides.append((found[1], found[2], step(found[3]), step(found[4])) if found else step(leaves[k]))
            model.trees[kind].append((feature, cut, *sides))
    held = table.where("fold = 3").withColumn("raw", F.floor(model.raw() / 10_000) * 10_000).where("raw IS NOT NULL")
    scores: dict[int, list] = {}
    for r in held.groupBy("kind", "raw").agg(F.sum(F.col("n") * F.col("label")).alias("yes"), F.sum("n").alias("n")).orderBy("raw").collect():
        scores.setdefault(r["kind"], []).append((r["raw"], r["yes"], r["n"]))
    for kind, rows in scores.items():
        fit_ = [c for c in calibrated(rows) if c[1] >= precision * c[2]]
        if model.trees[kind] and sum(c[2] for c in fit_) >= least_passed:
            model.thresholds[kind] = fit_[0][0]
    return model


def calibrated(rows: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(least score, labelled, all) of ascending scores, neighbours pooled until the labelled share rises throughout: isotonic regression."""
    pools: list[tuple[int, int, int]] = []
    for raw, yes, n in rows:
        while pools and pools[-1][1] * n >= yes * pools[-1][2]:
            raw, y, k = pools.pop()
            yes, n = yes + y, n + k
        pools.append((raw, yes, n))
    return pools


def find_private(docs: DataFrame, precision: float = PRECISION, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """docs with two columns more: `base_spans` and `private_spans`, both (kind, start, end) in code points, end exclusive.

    The base is what the patterns of BASE match, leftmost and without overlap for each kind, and its checks pass: parts of addresses up to
    255, cards of 16 to 19 digits by Luhn, phone numbers of 8 to 15 digits. private_spans has the base and, of the spans
    that the generators propose and no base span overlaps, those whose score reaches the threshold of their kind; they may
    overlap each other. kind is the place in KINDS, by which both are sorted, then by start and end.

    Trees are learnt from all texts: spans that the base has are labelled, others are not. Left out is what overlaps a base span of its kind, and
    what has the form of the base but was lost to a neighbour, as the base takes the leftmost match and tries no other: that is what is looked for. Feature vectors are counted before anything else, so rounds read a table of distinct vectors. A fourth of the
    rows, by crc32 of the id, is held back for thresholds. Without enough spans of a kind nothing is added to its base.

    Null texts are empty, and stay null if kept. Rows of one id or of null id are rows like any other. Without keep_text the texts are left out.
    Columns named base_spans and private_spans are replaced; other columns pass through.
    """
    docs = docs.drop("base_spans", "private_spans")
    kept = [F.col(f"`{c}`").alias(f"__c{k}") for k, c in enumerate(docs.columns) if keep_text or c != text_col]
    names = [c for c in docs.columns if keep_text or c != text_col]
    text = F.when(F.col(f"`{text_col}`").rlike("[0-9@]"), F.col(f"`{text_col}`")).otherwise("")
    rows = docs.select(*kept, F.coalesce(F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(4)), F.lit(0)).cast("int").alias("fold"), text.alias("__text"))
    patterns = [*BASE.values(), ZONE, LOOSE_EMAIL]
    cuts: dict[str, Column] = {}
    for kind, pattern in enumerate(patterns):
        cuts |= _found(F.col("__text"), pattern, kind)
    aliases = [f"__c{k}" for k, c in enumerate(docs.columns) if keep_text or c != text_col]
    rows = rows.withColumns(cuts).select(*aliases, "fold", F.concat(*[_items(k) for k in range(len(patterns))]).alias("items"), F.monotonically_increasing_id().alias("__row"))
    found = durable(rows, "private-found")

    spaced = _spaced(found)
    base = spaced.where("kind < 4").where(_valid(F.col("kind"), F.col("match")))
    base = base.select("__row", "fold", "kind", "start", (F.col("start") + F.length("match")).alias("end"), F.lit(None).cast("array<int>").alias("f"), F.lit(True).alias("form"), F.lit(True).alias("base"))
    proposed = _email_candidates(spaced).unionByName(_number_candidates(spaced)).withColumn("base", F.lit(False))
    spans = base.unionByName(proposed).groupBy("__row", "fold", "kind", "start", "end").agg(F.max("base").alias("base"), F.max("f").alias("f"), F.max("form").alias("form"))
    spans = durable(_overlaps(spans), "private-spans")

    learnt = spans.where("f IS NOT NULL AND (base OR NOT same AND NOT form)")
    table = durable(learnt.groupBy("kind", "f", "fold", F.col("base").cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n")), "private-vectors")
    model = fit(table, rounds, precision)
    forget(table)
    chosen = spans.withColumn("raw", model.raw()).where(F.col("base") | (F.col("f").isNotNull() & ~F.col("any") & model.passes("raw")))
    span = F.struct("kind", "start", "end")
    lists = chosen.groupBy("__row").agg(F.array_sort(F.collect_list(F.when(F.col("base"), span))).alias("base_spans"), F.array_sort(F.collect_list(span)).alias("private_spans"))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    out = found.drop("items", "fold").join(lists, "__row", "left")
    return out.select(*[F.col(a).alias(n) for a, n in zip(aliases, names, strict=True)], F.coalesce("base_spans", none).alias("base_spans"), F.coalesce("private_spans", none).alias("private_spans"))


def redacted(found: DataFrame, text_col: str = "text") -> Column:
    """The text of find_private() with each run of overlapping private spans replaced by the kind of its first, in brackets; null stays null."""
    text, spans = F.col(f"`{text_col}`"), F.array_sort(F.transform("private_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    begun = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def put(state, s):
        new = F.concat(state["out"], F.array(F.concat(F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int")), F.element_at(names, s["kind"] + 1))))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(s["start"] >= state["at"], new).otherwise(state["out"]).alias("out"))

    return F.when(F.size("private_spans") == 0, text).otherwise(
        F.aggregate(spans, begun, put, lambda state: F.concat(F.array_join(state["out"], ""), F.substring(text, (state["at"] + 1).cast("int"), F.length(text))))
    )


def private_data(docs: DataFrame, precision: float = PRECISION, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added): counts are of the base, spans are all of find_private()."""
    found = find_private(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), precision, rounds, keep_text=False)
    names = F.array(*[F.lit(k) for k in KINDS])
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")
    counts = [F.size(F.array_remove(F.transform("base_spans", lambda s: s["kind"] == F.lit(kind)), False)).cast("long").alias(f"n_{name}") for kind, name in enumerate(KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(told("base_spans").cast("binary"), 256).alias("base_sha256"), told("private_spans").alias("spans"),
        (F.size("private_spans") - F.size("base_spans")).cast("long").alias("n_added"),
    )

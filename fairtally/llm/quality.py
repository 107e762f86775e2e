"""Quality rules by weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

Everything on the rows is built-in column functions; the driver sees only the counts of the vote
patterns, at most 3 ** (number of rules) rows whatever the size of the corpus.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairtally.llm.common import stored, with_computed

WINDOW = 5
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
ROUNDS = 200
SMOOTH = 1.0
MOST_BLAME, START_BLAME = 0.001, 0.3


def text_stats(documents: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """The rows (all columns, repeated rows too) as struct ``row``, with the statistics of their whole text.
    Without ``keep_text`` the text is not in ``row``.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_ends, n_upper,
    n_shouts: all long; a null text has none of anything.
    """
    kept = [F.col(f"`{c}`") for c in documents.columns if keep_text or c != text]
    rows = documents.select(F.struct(*kept).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    t = F.col("_text")
    # Splitting at one plain character is far cheaper than at a pattern.
    words = F.array_remove(F.split(F.regexp_replace(t, r"[\x09-\x0D]", " "), " "), "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    a = with_computed(rows, words=words, lines=lines)
    n = F.size("words")
    at = lambda i: F.get("words", i)
    windows = F.when(
        n >= WINDOW,
        F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[at(i + k) for k in range(WINDOW)])),
    )
    last = lambda x: F.right(F.rtrim(x), F.lit(1))
    a = with_computed(
        a,
        n_words=n.cast("long"),
        word_chars=F.char_length(F.array_join("words", "")).cast("long"),
        n_symbols=F.regexp_count(t, F.lit(f"[{SYMBOLS}]")).cast("long"),
        n_shouts=(F.octet_length(t) - F.octet_length(F.replace(t, F.lit("!"), F.lit("")))).cast("long"),
        n_lines=F.size("lines").cast("long"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        n_ends=F.size(F.filter("lines", lambda x: last(x).isin(*".!?\"')…”»"))).cast("long"),
        n_upper=(F.char_length(t) - F.char_length(F.regexp_replace(t, r"\p{Lu}+", ""))).cast("long"),
        windows=windows,
    )
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    order = F.when(repeats, F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("p")))))
    a = with_computed(a.drop("_text", "words", "lines"), order=order).drop("windows")
    near = lambda x, i: F.coalesce(x["h"] == F.get("order", i)["h"], F.lit(False))
    found = F.array_sort(F.transform(F.filter("order", lambda x, i: near(x, i - 1) | near(x, i + 1)), lambda x: x["p"]))
    a = with_computed(a, places=found).drop("order")
    gaps = F.transform(
        F.sequence(F.lit(1), F.size("places") - 1),
        lambda i: F.least(F.lit(WINDOW), F.get("places", i) - F.get("places", i - 1)),
    )
    covered = F.aggregate(gaps, F.lit(WINDOW), lambda acc, x: acc + x)
    return a.withColumn("n_repeat_words", F.when(F.size("places") > 1, covered).otherwise(0).cast("long")).drop("places")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("tinyint")


def rule_votes() -> dict[str, Column]:
    """Each rule votes 1 (good), -1 (bad) or 0 (abstains)."""
    length = _share("word_chars", "n_words")
    symbols, repeats = _share("n_symbols", "n_words"), _share("n_repeat_words", "n_words")
    dup, ends = _share("n_dup_lines", "n_lines"), _share("n_ends", "n_lines")
    upper, shouts = _share("n_upper", "word_chars"), _share("n_shouts", "n_words")
    enough = F.col("n_words") >= MIN_WORDS
    lines = F.col("n_lines") >= 3
    letters = F.col("word_chars") >= 40
    none = F.lit(False)
    # A text without one kind of fault may have another: most rules only blame or abstain.
    return {
        "symbols": _vote(none, symbols > 0.2),
        "repeats": _vote(none, repeats > 0.2),
        "dup_lines": _vote(none, lines & (dup > 0.4)),
        "upper_case": _vote(none, letters & (upper > 0.6)),
        "shouts": _vote(none, shouts > 0.3),
        "line_ends": _vote(enough & (ends > 0.6), enough & (ends < 0.2)),
        "word_length": _vote(enough & length.between(3.0, 13.0), enough & ((length < 2.0) | (length > 30.0))),
    }


@dataclass(frozen=True)
class LabelModel:
    """Prior of good text, and per rule the rates of the votes (-1, 0, 1) on good and on bad text."""

    rules: tuple[str, ...]
    prior: float
    on_good: tuple[tuple[float, float, float], ...]
    on_bad: tuple[tuple[float, float, float], ...]

    def weights(self) -> list[list[float]]:
        """Log odds that each vote of each rule adds."""
        return [[math.log(g / b) for g, b in zip(*pair)] for pair in zip(self.on_good, self.on_bad)]

    @property
    def base(self) -> float:
        return math.log(self.prior / (1 - self.prior))


def _rates(counts: list[float], most_blame: float | None) -> tuple[float, float, float]:
    """Smoothed shares of the votes; a cap on blame goes to the other two."""
    total = sum(counts) + 3 * SMOOTH
    blame, silent, praise = [(c + SMOOTH) / total for c in counts]
    if most_blame is not None and blame > most_blame:
        scale = (1 - most_blame) / (silent + praise)
        blame, silent, praise = most_blame, silent * scale, praise * scale
    return blame, silent, praise


def fit_label_model(votes: DataFrame, rules: list[str], rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over the counts of all vote patterns.

    A text is good or bad; given that, rules vote independently, each with its own rates of blame,
    silence and praise. The start (a rule blames 1 of 1000 good and 300 of 1000 bad texts) says which
    class is which, and no rule may come to blame more than 1 of 1000 good texts: rules are written
    to be precise, and bad text of one kind is known by few of them. No rows leave the start.
    """
    counted = votes.groupBy(*rules).agg(F.count(F.lit(1)).alias("_n")).collect()
    patterns = sorted((tuple(row[r] for r in rules), row["_n"]) for row in counted)
    seen = [[sum(n for p, n in patterns if p[i] == v) for v in (-1, 0, 1)] for i in range(len(rules))]

    def start(blame: float) -> tuple[tuple[float, float, float], ...]:
        rest = [_rates(s, None) for s in seen]
        return tuple((blame, (1 - blame) * r[1] / (r[1] + r[2]), (1 - blame) * r[2] / (r[1] + r[2])) for r in rest)

    model = LabelModel(tuple(rules), 0.8, start(MOST_BLAME), start(START_BLAME))
    for _ in range(rounds if patterns else 0):
        good = [[0.0] * 3 for _ in rules]
        bad = [[0.0] * 3 for _ in rules]
        mass = total = 0.0
        weights, base = model.weights(), model.base
        for pattern, n in patterns:
            odds = base + sum(w[v + 1] for w, v in zip(weights, pattern))
            p = n / (1 + math.exp(-min(700.0, max(-700.0, odds))))
            mass, total = mass + p, total + n
            for i, v in enumerate(pattern):
                good[i][v + 1] += p
                bad[i][v + 1] += n - p
        prior = min(0.99, max(0.01, (mass + SMOOTH) / (total + 2 * SMOOTH)))
        after = LabelModel(
            model.rules, prior, tuple(_rates(c, MOST_BLAME) for c in good), tuple(_rates(c, None) for c in bad)
        )
        moved = max(abs(x - y) for a, b in zip(after.on_good + after.on_bad, model.on_good + model.on_bad) for x, y in zip(a, b))
        model = after
        if moved < 1e-9:
            break
    return model


def posterior(model: LabelModel, votes: dict[str, Column]) -> Column:
    """Probability of good text given the votes, as one column expression."""
    odds = F.lit(model.base)
    for name, (blame, silent, praise) in zip(model.rules, model.weights()):
        v = votes[name]
        odds = odds + F.when(v < 0, blame).when(v > 0, praise).otherwise(silent)
    return 1 / (1 + F.exp(-odds))


def judge_quality(documents: DataFrame, least: float = 0.5, text: str = "text", keep_row: bool = False) -> DataFrame:
    """The statistics of every row with base_failed, quality (the posterior) and kept.

    The model learns from the rows that pass the base rules, as only they need its verdict.
    With ``keep_row`` the texts are read twice, once for the votes of the whole corpus and once to
    judge; otherwise the statistics are written once, and ``row`` loses its text.
    """
    stats = text_stats(documents, text, keep_text=keep_row)
    if not keep_row:
        stats = stored(stats, "quality")
    votes = stats.where(~base_failed()).select(*[v.alias(r) for r, v in rule_votes().items()])
    model = fit_label_model(votes, list(rule_votes()))
    judged = stats.withColumn("quality", posterior(model, rule_votes())).withColumn("base_failed", base_failed())
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))

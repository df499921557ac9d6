"""Personal data by weak-supervision aggregation. DataFrame functions only.

Base spans. Four kinds are found by pattern, leftmost and without overlap within a kind, and
then checked: email, ip (parts at most 255), card (13 to 19 digits, Luhn), phone
(9 to 15 digits). They always stay.

Added spans. Broad patterns propose candidates of the kinds phone (national
form) and secret (passwords, keys, tokens) outside the base spans. Regex, gazetteer and context
labelers vote yes (1), no (0) or abstain (-) on each candidate. Expectation-
maximisation over the counts of vote patterns of all documents estimates each labeler's reliabilities
and each pattern's probability of being true. A logistic classifier over votes and
span features is then trained on those probabilities; a candidate whose
score is at least one half becomes a span.

The texts are scanned once. What is collected is one row per kind, vote
pattern and feature bucket: at most 3^5 * 4^3 rows per kind, whatever the data.

Offsets are code points, the end is exclusive. The patterns start only where a run
starts (or the last match ended) and never give back characters, so the time is
linear in the text.

Defined results: null and empty texts have no spans; repeated rows get equal spans; an
empty table gives no rows; without candidates nothing is added; extra columns are kept.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memtables.session import materialized

KINDS = ("email", "ip", "card", "phone", "secret")

EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

#: Candidates: national phone numbers; long tokens of letters and digits.
NATIONAL = r"(?<![0-9A-Za-z+])(?:\([0-9]{2,4}\)[\x20]?|[0-9]{2,4}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])"
TOKEN = r"(?<![A-Za-z0-9_])(?=[A-Za-z_]*+[0-9])(?=[0-9_]*+[A-Za-z])[A-Za-z0-9_]{16,}+"
PHONE_CUES = r"(?i)\b(?:tel|phone|telephone|call|mobile|cell|fax|dial|contact|telefon|t[eé]l[eé]fon\w*|handy)\b[^0-9]*$"
SECRET_CUES = r"(?i)(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|credential|auth|passwort|contraseña|clave)[^0-9A-Za-z]*$"
BEFORE = 32


#: Items that one step of a running sum appends to one array.
LOT = 256


def _let(x: Column, f) -> Column:
    """f(x) with x computed once."""
    return F.element_at(F.transform(F.array(x), f), 1)


def running(items: Column, measure, combine, zero: int) -> Column:
    """For each item what ``combine`` (``zero`` is neutral for it) makes of the measures (int) of all items before it.
    An array that grows by one item is copied each time, so the items are taken in lots: first the lots' totals, then
    the items of each lot from its total on."""
    def before(x: Column, start: Column) -> Column:
        return F.aggregate(x, F.struct(start.alias("at"), F.array().cast("array<int>").alias("out")), lambda a, n: F.struct(
            combine(a["at"], n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])
    first = F.lit(zero)

    def lots(m: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(m) - 1) / LOT).cast("int")), lambda i: F.slice(m, i * LOT + 1, LOT))

    def total(cut: Column) -> Column:
        return before(F.transform(cut, lambda x: F.aggregate(x, first, combine)), first)
    by_lot = lambda cut: _let(total(cut), lambda starts: F.flatten(F.transform(
        cut, lambda x, i: before(x, F.element_at(starts, i + 1)))))
    return _let(F.transform(items, measure), lambda m: F.when(F.size(m) > 0, _let(lots(m), by_lot)).otherwise(F.array().cast("array<int>")))


def _spans(text: Column, pattern: str) -> Column:
    """Array of (start, end, hit, before) of all matches; the matches and what stands
    between them alternate, so offsets are running sums of lengths."""
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    both = F.zip_with(hits, F.slice(gaps, F.lit(1), F.size(hits)), lambda h, g: F.struct(
        h.alias("h"), F.right(g, F.lit(BEFORE)).alias("before"), F.length(g).alias("g_n"), F.length(h).alias("h_n")))
    at = lambda p: running(p, lambda x: x["g_n"] + x["h_n"], lambda a, n: a + n, 0)
    return _let(both, lambda p: F.zip_with(p, at(p), lambda x, n: F.struct(
        (n + x["g_n"]).alias("start"), (n + x["g_n"] + x["h_n"]).alias("end"), x["h"].alias("hit"), x["before"].alias("before"))))


def outside(found: Column, base: Column) -> Column:
    """The spans (start, end, code) that overlap no ``base`` span: both in one order by start, with the largest end
    of a base span before and the smallest start of one behind."""
    far = 2 ** 31 - 1
    own = F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(1).alias("own"), s["end"].alias("end"), s["code"].alias("code")))
    other = F.transform(base, lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("own"), s["end"].alias("end"), F.lit("").alias("code")))
    ends = lambda x: running(x, lambda s: F.when(s["own"] == 0, s["end"]).otherwise(0), lambda a, n: F.greatest(a, n), 0)
    starts = lambda x: F.reverse(running(F.reverse(x), lambda s: F.when(s["own"] == 0, s["start"]).otherwise(far), lambda a, n: F.least(a, n), far))
    marked = lambda x: F.zip_with(F.zip_with(x, ends(x), lambda s, e: F.struct(s.alias("s"), e.alias("e"))), starts(x),
                                  lambda p, n: F.struct(p["s"].alias("s"), p["e"].alias("e"), n.alias("n")))
    clear = lambda x: F.filter(marked(x), lambda p: (p["s"]["own"] == 1) & (p["e"] <= p["s"]["start"]) & (p["n"] >= p["s"]["end"]))
    kept = F.transform(_let(F.sort_array(F.concat(other, own)), clear), lambda p: F.struct(
        p["s"]["start"].alias("start"), p["s"]["end"].alias("end"), p["s"]["code"].alias("code")))
    return F.when((F.size(found) == 0) | (F.size(base) == 0), found).otherwise(kept)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(hit: Column) -> Column:
    d = F.reverse(_digits(hit))
    value = lambda i: F.substring(d, i, F.lit(1)).cast("int")
    total = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(d), F.lit(1))), F.lit(0), lambda a, i: a + F.when(
        i % 2 == 1, value(i)).otherwise(F.when(value(i) > 4, 2 * value(i) - 9).otherwise(2 * value(i))))
    return total % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Array of (start, end, hit, before) by kind. Texts without the kind's first need skip the pattern."""
    none = F.array().cast("array<struct<start:int,end:int,hit:string,before:string>>")
    scan = lambda need, pattern, good: F.when(need, F.filter(_spans(text, pattern), lambda s: good(s["hit"]))).otherwise(none)
    n_digits = lambda h: F.length(_digits(h))
    return {
        "email": scan(text.contains("@"), EMAIL, lambda h: F.lit(True)),
        "ip": scan(text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), IP, lambda h: h.rlike(rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$")),
        "card": scan(text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"), CARD, lambda h: n_digits(h).between(13, 19) & luhn(h)),
        "phone": scan(text.contains("+"), PHONE, lambda h: n_digits(h).between(9, 15)),
    }


# -- labelers ------------------------------------------------------------------

def _vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, "1")
    return (out.when(no, "0") if no is not None else out).otherwise("-")


def _bucket(x: Column, *cuts: float) -> Column:
    out = F.lit(str(len(cuts)))
    for i in reversed(range(len(cuts))):
        out = F.when(x < cuts[i], F.lit(str(i))).otherwise(out)
    return out


N_VOTES = 5


def _phone_code(s: Column) -> Column:
    hit, before = s["hit"], s["before"]
    n = F.length(_digits(hit))
    return F.concat(
        _vote(hit.rlike(r"^\([0-9]{3}\)"), None),                                  # regex: area code in brackets
        _vote(hit.rlike(r"^[0-9]{3}([\x20.-])[0-9]{3}\1[0-9]{4}$"), hit.rlike(r"^[0-9]{2}[\x20.-]")),   # regex: equal separators
        _vote(before.rlike(PHONE_CUES)),                                            # gazetteer
        _vote(before.rlike(r"[:(]\s*$"), before.rlike(r"[0-9=#$€%.,/-]\s*$")),      # context
        _vote(n.between(10, 11), n < 9),                                            # length
        _bucket(n, 9, 10, 11), _bucket(F.regexp_count(hit, F.lit("[-. ]")), 1, 2, 3), _bucket(F.length(F.btrim(before)), 1, 16, 31))


def _secret_code(s: Column) -> Column:
    hit, before = s["hit"], s["before"]
    digits = F.length(_digits(hit)) / F.length(hit)
    turns = F.regexp_count(hit, F.lit("[0-9][A-Za-z]|[A-Za-z][0-9]"))
    return F.concat(
        _vote(hit.rlike("^(?:AKIA|ASIA)[A-Z0-9]{16}$|^(?:ghp|gho|sk|pk|rk)_[A-Za-z0-9_]+$")),  # regex: known forms
        _vote(hit.rlike("^(?:[0-9a-f]{16,}|[0-9A-F]{16,})$")),                      # regex: hexadecimal
        _vote(before.rlike(SECRET_CUES)),                                           # gazetteer
        _vote(before.rlike(r"[=:]\s*[\"']?$"), before.rlike(r"[/.@]$")),            # context: assigned; part of an address
        _vote(turns >= 3, digits < 0.1),                                            # letters and digits mixed
        _bucket(F.length(hit), 20, 32, 40), _bucket(digits, 0.1, 0.3, 0.7), _bucket(turns, 2, 4, 8))


def candidates(text: Column) -> dict[str, Column]:
    """Array of (start, end, code) by kind; ``code``: a character for each vote and each feature."""
    none = F.array().cast("array<struct<start:int,end:int,code:string>>")
    coded = lambda need, pattern, code: F.when(need, F.transform(_spans(text, pattern), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), code(s).alias("code")))).otherwise(none)
    return {"phone": coded(text.rlike(r"[0-9]{3}[\x20.-][0-9]{4}"), NATIONAL, _phone_code),
            "secret": coded(text.rlike("[A-Za-z_]{1,64}[0-9]|[0-9][A-Za-z_]"), TOKEN, _secret_code)}


# -- aggregation of the votes --------------------------------------------------

def reliabilities(patterns: dict[str, float], *, steps: int = 50) -> tuple[float, list[tuple[float, float]], dict[str, float]]:
    """Expectation-maximisation over counts of vote patterns. Returns the share of true
    candidates, for each labeler the probabilities that its vote is yes on a true and on a
    false candidate, and each pattern's probability of being true. Abstaining says
    nothing. The prior, a quarter as heavy as a labeler's votes, holds that votes are right
    four times in five; it settles what a labeler that never votes no is worth."""
    n, total = len(next(iter(patterns))), sum(patterns.values())
    share, table = 0.5, [(0.8, 0.2)] * n
    truth: dict[str, float] = {}
    for _ in range(steps):
        for p in patterns:
            odds = math.log(share / (1 - share))
            for (yes, no), v in zip(table, p):
                odds += 0 if v == "-" else math.log(yes / no) if v == "1" else math.log((1 - yes) / (1 - no))
            truth[p] = 1 / (1 + math.exp(max(-50.0, min(50.0, -odds))))
        share = min(0.95, max(0.05, (sum(c * truth[p] for p, c in patterns.items()) + 1) / (total + 2)))
        for j in range(n):
            voted = {p: c for p, c in patterns.items() if p[j] != "-"}
            prior = 4 + 0.25 * sum(voted.values())
            rate = []
            for true, right in ((True, 0.8), (False, 0.2)):
                w = {p: c * (truth[p] if true else 1 - truth[p]) for p, c in voted.items()}
                rate.append((sum(x for p, x in w.items() if p[j] == "1") + right * prior) / (sum(w.values()) + prior))
            table[j] = (rate[0], rate[1])
    return share, table, truth


@dataclass
class SpanClassifier:
    """Logistic: ``bias`` plus a weight for the character at each place of a code."""
    bias: float
    weights: list[dict[str, float]]

    def accepts(self, code: Column) -> Column:
        z = F.lit(self.bias)
        for j, w in enumerate(self.weights):
            at = F.substring(code, j + 1, 1)
            for v, x in sorted(w.items()):
                z = z + F.when(at == v, F.lit(x)).otherwise(F.lit(0.0))
        return z >= 0


def train(codes: dict[str, float], *, steps: int = 400, rate: float = 0.5, l2: float = 1e-3) -> SpanClassifier:
    """``codes``: counts by code. Votes give the probabilities, votes and features the classifier."""
    patterns: dict[str, float] = {}
    for code, c in codes.items():
        patterns[code[:N_VOTES]] = patterns.get(code[:N_VOTES], 0.0) + c
    truth = reliabilities(patterns)[2]
    total = sum(codes.values())
    bias, weights = 0.0, [{v: 0.0 for v in sorted({code[j] for code in codes})} for j in range(len(next(iter(codes))))]
    for _ in range(steps):
        slope, slopes = 0.0, [dict.fromkeys(w, 0.0) for w in weights]
        for code, c in codes.items():
            z = bias + sum(w[v] for w, v in zip(weights, code))
            e = (1 / (1 + math.exp(max(-50.0, min(50.0, -z)))) - truth[code[:N_VOTES]]) * c / total
            slope += e
            for s, v in zip(slopes, code):
                s[v] += e
        bias -= rate * slope
        for w, s in zip(weights, slopes):
            for v in w:
                w[v] -= rate * (s[v] + l2 * w[v])
    return SpanClassifier(bias, weights)


def _accepted(found: Column, model: SpanClassifier) -> Column:
    return F.filter(found, lambda s: model.accepts(s["code"]))


def find(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns but the text) and ``base`` and ``spans``: arrays of (kind, start, end)
    by kind as in ``KINDS``, then start. ``spans`` holds the base ones too."""
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in (text, "base", "spans")]
    none = F.array().cast("array<struct<rank:int,start:int,end:int,kind:string>>")
    t = F.coalesce(F.col(text), F.lit(""))

    def tagged(kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(F.lit(KINDS.index(kind)).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))
    base = F.concat(*(tagged(k, s) for k, s in base_spans(t).items()))
    proposed = candidates(t)
    row = F.struct(*(F.col(f"`{c}`") for c in keep)).alias("_row")
    found = materialized(docs.select(row, base.alias("base"), *(c.alias(f"_{k}") for k, c in proposed.items())))
    found = found.select("_row", "base", *(outside(F.col(f"_{k}"), F.col("base")).alias(f"_{k}") for k in proposed))
    counts: dict[str, dict[str, float]] = {k: {} for k in proposed}
    with_kind = lambda k: F.transform(f"_{k}", lambda s: F.struct(F.lit(k).alias("kind"), s["code"].alias("code")))
    each = F.explode(F.concat(*map(with_kind, proposed)))
    for r in found.select(each.alias("c")).groupBy("c.kind", "c.code").count().collect():
        counts[r["kind"]][r["code"]] = float(r["count"])
    added = [none]
    for k, codes in counts.items():
        if codes:
            model = train(dict(sorted(codes.items())))
            added.append(tagged(k, _accepted(F.col(f"_{k}"), model)))
    final = lambda spans: F.transform(F.sort_array(spans), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return found.select("_row.*", final(F.col("base")).alias("base"), final(F.concat("base", *added)).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

"""Secret scans: fixed patterns, and character Markov models of random strings and identifiers.

Two models of character pairs, one of random strings and one of ordinary identifiers, are trained from
labelled strings; a token holds a secret if the log-likelihood ratio of the two is large enough over some
stretch of it, so that no ordinary path or key in front of a secret hides it.
DataFrame functions only.
"""

from __future__ import annotations

import math
import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import staged, text_or_empty

# The patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
# The same, looked for where only they can start, and at once as long as a finding must be: both are runs
# that end with their alphabet, so a run that is too short holds no longer one.
ASSIGN_AT = rf"(?=[PpSsTtAa]){ASSIGN}"
LONG_ACCESS = r"AKIA[A-Z0-9]{12,}"
LONG_HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "[A-Za-z0-9+/_.=-]"
LEAST = 16
"""Characters of the shortest token, and of the shortest stretch of one, that can be random."""
TOKEN = rf"(?<!{ALPHABET}){ALPHABET}{{{LEAST},}}"
CODES = 128
SAMPLE_DOCS = 2000
"""Documents whose strings train the two models: those with the smallest hash of their id."""
BACK_OFF = 8.0
"""Pairs that the kinds of the two characters count for beside those seen."""
MIN_RATIO = 12.0
"""Log-likelihood ratio, in nats, from which a token counts as random, beside what its length adds."""
MOST_PER_PAIR = 3.0
"""A single pair of characters weighs no more than this, however rarely it was seen."""
LEAST_DISTINCT = 7
"""Different letters and digits of a random token; rules and repeated characters have fewer."""
UUID = "[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
"""Identifiers of this form are public names and no secrets, alone or with a path or key in front."""
SEPARATORS = "+/_.=-"
# Ordinary strings of kinds that prose has few of, labelled by hand.
ORDINARY = (
    "https//www.example.org/2023/11/08/annual-report-2022.html", "/usr/local/lib/python3.12/site-packages/numpy",
    "/var/log/nginx/access.log.2.gz", "/etc/systemd/system/multi-user.target", "com.example.project.ServiceFactory",
    "org.apache.commons.lang3.StringUtils", "getElementById.addEventListener", "XMLHttpRequest.onReadyStateChange",
    "HTTP_STATUS_404_NOT_FOUND", "MAX_CONNECTION_TIMEOUT_MS", "ERROR_INVALID_PARAMETER_87", "ISO_8859_1_ENCODING",
    "2021-03-14T15", "1999-12-31-23-59-59", "20200229-101500", "1234567890", "00000000", "192.168.100.254",
    "127.0.0.1/8080", "v2.10.3-rc1", "release-2019.04.1", "linux-image-5.4.0-42-generic", "amd64-gnu-linux",
    "chapter-12-section-3", "page_0042_of_0100", "IMG_20180704_183045.jpg", "invoice-2020-000123.pdf",
    "file001.txt", "DSC00123.JPG", "RFC-2616-section-14.9", "ISBN-978-3-16-148410-0", "utf-8-sig", "base64_encode",
    "int64_t", "uint32_max", "float32", "sha256sum", "md5_hexdigest", "libssl1.1", "gcc-9.3.0", "node_modules/.bin",
    "WindowsServer2019DataCenter", "iPhone12ProMax", "QtWebEngineCore", "OpenGL4.6", "DirectX12", "JavaScriptES2015",
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def running_sum(values: Column) -> Column:
    """Running sums of an array, in as many passes as its length has binary digits."""
    steps = F.sequence(F.lit(0), F.length(F.bin(F.size(values))))

    def add(sums: Column, step: Column) -> Column:
        back = F.pow(F.lit(2), step).cast("int")
        return F.transform(sums, lambda x, i: x + F.when(i >= back, F.get(sums, i - back)).otherwise(0))

    return F.aggregate(steps, values, add)


def no_spans() -> Column:
    return F.array().cast("array<struct<start:int,stop:int,kind:int,value:string>>")


def spans(text: Column, pattern: str, kind: str, least: int, value_group: int = 0) -> Column:
    """Leftmost non-overlapping matches whose group has ``least`` characters or more.

    A match starts where the texts between the matches and the matches before it end.
    """

    def placed(found: Column) -> Column:
        def of_sizes(between: Column) -> Column:
            return F.transform(found, lambda m, i: F.length(F.get(between, i)) + F.length(m))

        def of_stops(stops: Column) -> Column:
            values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else found
            every = F.transform(
                F.arrays_zip(stops.alias("stop"), found.alias("match"), values.alias("value")),
                lambda x: F.struct(
                    (x["stop"] - F.length(x["match"])).alias("start"),
                    x["stop"].alias("stop"),
                    F.lit(KINDS.index(kind)).alias("kind"),
                    x["value"].alias("value"),
                ),
            )
            return F.filter(every, lambda x: F.length(x["value"]) >= least)

        sizes = let(F.split(text, pattern, -1), of_sizes)
        return F.when(F.size(found) == 0, no_spans()).otherwise(let(let(sizes, running_sum), of_stops))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns, kind after kind."""
    return F.concat(
        spans(text, ASSIGN_AT, "assign", 8, value_group=2),
        spans(text, LONG_ACCESS, "access", 16),
        spans(text, LONG_HEX, "hex", 32),
    )


def codes(token: Column) -> Column:
    """Character codes of a token of the alphabet."""
    return F.transform(F.sequence(F.lit(1), F.length(token)), lambda i: F.ascii(F.substring(token, i, 1)))


def labelled_strings(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Strings labelled by the fixed patterns: ``token``, ``random``.

    What the patterns find is random if it has ``LEAST_DISTINCT`` characters and a digit (a word after
    ``token:`` is none); every other run of six characters or more of the same alphabet is an ordinary
    identifier, in capitals and with a capital as well, and so are the strings of ``ORDINARY``.
    """
    rest = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(F.col("t"), ASSIGN_AT, " "), LONG_ACCESS, " "), LONG_HEX, " "
    )
    ordinary = F.regexp_extract_all(rest, F.lit(rf"(?<!{ALPHABET}){ALPHABET}{{6,}}"), F.lit(0))
    texts = docs.select(text_or_empty(text_col).alias("t"))
    both = texts.select(
        F.concat(
            F.transform(
                F.filter(base_spans(F.col("t")), lambda s: various(s["value"]) & s["value"].rlike("[0-9]")),
                lambda s: F.struct(s["value"].alias("token"), F.lit(True).alias("random")),
            ),
            F.transform(ordinary, lambda w: F.struct(w.alias("token"), F.lit(False).alias("random"))),
            F.transform(ordinary, lambda w: F.struct(F.upper(w).alias("token"), F.lit(False).alias("random"))),
            F.transform(ordinary, lambda w: F.struct(F.initcap(w).alias("token"), F.lit(False).alias("random"))),
        ).alias("s")
    )
    by_hand = docs.sparkSession.range(1).select(
        F.explode(F.array(*map(F.lit, ORDINARY))).alias("token"), F.lit(False).alias("random")
    )
    return both.select(F.inline("s")).unionAll(by_hand)


def various(token: Column) -> Column:
    """Whether a token has ``LEAST_DISTINCT`` different letters and digits."""
    plain = F.regexp_replace(token, "[^A-Za-z0-9]", "")
    return F.size(F.array_distinct(F.split(plain, ""))) >= LEAST_DISTINCT


def train(strings: DataFrame) -> list[float]:
    """Log ratio of the two models for each pair of characters, by ``first * CODES + second``.

    ``strings`` has ``token`` and ``random``; nulls and tokens shorter than two characters add nothing.
    A pair backs off to that of its kinds (small letter, capital, digit), this to how often the second kind
    comes at all, and to the second character's share of its kind, smoothed. Pairs with a separator say nothing, for either class: they are where words, dates
    and versions are joined. A pair weighs ``MOST_PER_PAIR`` at most. At most one row per class and pair of
    characters reaches the driver.
    """
    pairs = (
        strings.where("random IS NOT NULL AND length(token) > 1")
        .select("random", codes(F.col("token")).alias("c"))
        .select(
            "random",
            F.explode(
                F.transform(
                    F.sequence(F.lit(0), F.size("c") - 2),
                    lambda i: F.struct(F.get(F.col("c"), i).alias("a"), F.get(F.col("c"), i + 1).alias("b")),
                )
            ).alias("p"),
        )
        .select("random", "p.a", "p.b")
        .where(f"a < {CODES} AND b < {CODES} AND a > 0 AND b > 0")
        .groupBy("random", "a", "b")
        .count()
    )
    counts = {(r["random"], r["a"], r["b"]): r["count"] for r in pairs.collect()}
    kinds = ([ord(c) for c in string.ascii_lowercase], [ord(c) for c in string.ascii_uppercase], [ord(c) for c in string.digits])
    kind_of = {c: k for k, members in enumerate(kinds) for c in members}
    table = [0.0] * (CODES * CODES)
    chances = {label: _chances(counts, label, kinds, kind_of) for label in (True, False)}
    for a in kind_of:
        for b in kind_of:
            ratio = math.log(chances[True][a, b] / chances[False][a, b])
            table[a * CODES + b] = max(-MOST_PER_PAIR, min(MOST_PER_PAIR, ratio))
    return table


def _chances(counts: dict, label: bool, kinds: tuple, kind_of: dict) -> dict:
    """Chance of each second letter or digit after each first one, in one class.

    Half of a random character's share of its kind is uniform, since the labelled strings may know only
    some alphabets (hexadecimal, say) of those that secrets are drawn from.
    """
    own = {(a, b): n for (given, a, b), n in counts.items() if given == label and a in kind_of and b in kind_of}
    often = {b: 1.0 for b in kind_of}
    steps = dict.fromkeys([(j, k) for j in range(len(kinds)) for k in range(len(kinds))], 0)
    seen = dict.fromkeys(kind_of, 0)
    for (a, b), n in own.items():
        often[b] += n
        steps[kind_of[a], kind_of[b]] += n
        seen[a] += n
    in_kind = [sum(often[b] for b in members) for members in kinds]
    left = [sum(steps[j, k] for k in range(len(kinds))) for j in range(len(kinds))]
    of_kind = [n / sum(in_kind) for n in in_kind]
    chance = {}
    for a, j in kind_of.items():
        for b, k in kind_of.items():
            share = often[b] / in_kind[k]
            if label:
                share = (share + 1 / len(kinds[k])) / 2
            prior = (steps[j, k] + BACK_OFF * of_kind[k]) / (left[j] + BACK_OFF) * share
            chance[a, b] = (own.get((a, b), 0) + BACK_OFF * prior) / (seen[a] + BACK_OFF)
    return chance


def table_literal(table: list[float]) -> Column:
    """The table as a constant array that the optimizer folds once."""
    return F.split(F.lit(",".join(f"{x:.6f}" for x in table)), ",").cast("array<double>")


def log_ratio(token: Column, table: Column) -> Column:
    """Log-likelihood ratio of random string against identifier, over the pairs of a token."""

    def of_codes(c: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(0), F.size(c) - 2),
            F.lit(0.0),
            lambda s, i: s + F.get(table, F.get(c, i) * CODES + F.get(c, i + 1)),
        )

    return F.when(F.length(token) > 1, let(codes(token), of_codes)).otherwise(F.lit(0.0))


def best_ratio(token: Column, table: Column) -> Column:
    """The largest log-likelihood ratio of any stretch of ``LEAST`` characters or more of a token.

    One pass: the ratio up to each place, less the smallest at any place that far before it. A shorter token
    has the ratio of the whole.
    """
    pairs = LEAST - 1

    def of_ratios(ratios: Column) -> Column:
        def add(state: Column, i: Column) -> Column:
            gone = F.when(i >= pairs, F.get(ratios, i - pairs)).otherwise(0.0)
            total, last = state["total"] + F.get(ratios, i), state["last"] + F.get(ratios, i) - gone
            low = F.when(i >= pairs - 1, F.least(state["low"], total - last)).otherwise(state["low"])
            return F.struct(
                total.alias("total"),
                last.alias("last"),
                low.alias("low"),
                F.greatest(state["best"], total - low).alias("best"),
            )

        start = F.struct(
            F.lit(0.0).alias("total"),
            F.lit(0.0).alias("last"),
            F.lit(float("inf")).alias("low"),
            F.lit(float("-inf")).alias("best"),
        )
        places = F.sequence(F.lit(0), F.size(ratios) - 1)
        return F.aggregate(places, start, add, lambda state: state["best"])

    def of_codes(c: Column) -> Column:
        ratios = F.transform(
            F.sequence(F.lit(0), F.size(c) - 2),
            lambda i: F.get(table, F.get(c, i) * CODES + F.get(c, i + 1)),
        )
        return let(ratios, of_ratios)

    return F.when(F.length(token) >= LEAST, let(codes(token), of_codes)).otherwise(log_ratio(token, table))


def is_random(token: Column, table: Column, min_ratio: float = MIN_RATIO) -> Column:
    """Whether the models call a stretch of a token random, and the token has enough different characters."""
    beyond = F.greatest(F.length(token) - LEAST + 1, F.lit(1)).cast("double")
    return various(token) & (best_ratio(token, table) >= F.lit(min_ratio) + F.log(beyond * (beyond + 1) / 2))


def all_spans(text: Column, table: Column, min_ratio: float = MIN_RATIO) -> Column:
    """Base spans, and tokens that no base span touches and of which the models call a stretch random.

    Such a token is a span as a whole, with the path or key that the secret hangs on. A long token has many
    stretches and the best of many is large by chance, so the ratio must exceed ``min_ratio`` by the
    logarithm of their number. UUIDs are taken out of a token before it is judged.
    """

    def with_base(base: Column) -> Column:
        tokens = spans(text, TOKEN, "markov", LEAST)
        extra = F.filter(
            tokens,
            lambda t: let(F.regexp_replace(t["value"], UUID, "-"), lambda v: is_random(v, table, min_ratio))
            & ~F.exists(base, lambda b: (b["start"] < t["stop"]) & (b["stop"] > t["start"])),
        )
        every = F.concat(base, extra)
        return F.array_sort(
            F.transform(every, lambda s: F.struct(s["start"], s["kind"], s["stop"], s["value"]))
        )

    return let(base_spans(text), with_base)


def sample_of(docs: DataFrame, id_col: str = "doc_id", limit: int = SAMPLE_DOCS) -> DataFrame:
    """Training documents: the ``limit`` ids with the smallest hash; the models need no more."""
    ids = docs.select(F.col(id_col).alias("_id")).where("_id IS NOT NULL").distinct()
    chosen = staged(ids.orderBy(F.xxhash64("_id"), "_id").limit(limit), "secret-sample")
    return docs.join(chosen, docs[id_col] == chosen["_id"], "left_semi")


def scan(
    docs: DataFrame,
    table: list[float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_ratio: float = MIN_RATIO,
) -> DataFrame:
    """Each row with a column ``spans``: structs of start, kind (index into KINDS), stop and value, sorted
    by start and kind; places are code points, ends exclusive.

    Without a table the models are trained on :func:`sample_of`. A null or empty text has no spans;
    repeated rows are scanned alike; an empty table gives no rows. An input column named ``spans`` is
    replaced, others stay.
    """
    if table is None:
        table = train(labelled_strings(sample_of(docs, id_col), text_col))
    return docs.withColumn("spans", all_spans(text_or_empty(text_col), table_literal(table), min_ratio))


def joined_spans(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            found,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")
            ),
        ),
        ",",
    )


def redacted(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of touching or overlapping spans replaced by ``mark``."""

    def merged(runs: Column, s: Column) -> Column:
        last = F.get(runs, F.size(runs) - 1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop"))
        new = F.struct(s["start"].alias("start"), s["stop"].alias("stop"))
        return F.when(
            (F.size(runs) > 0) & (s["start"] <= last["stop"]),
            F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), F.array(longer)),
        ).otherwise(F.concat(runs, F.array(new)))

    def rebuilt(runs: Column) -> Column:
        pieces = F.transform(
            runs,
            lambda r, i: F.concat(
                F.substring(text, F.coalesce(F.get(runs, i - 1)["stop"], F.lit(0)) + 1,
                            r["start"] - F.coalesce(F.get(runs, i - 1)["stop"], F.lit(0))),
                F.lit(mark),
            ),
        )
        tail = F.substring(text, F.get(runs, F.size(runs) - 1)["stop"] + 1, F.length(text))
        return F.concat(F.array_join(pieces, ""), tail)

    runs = F.aggregate(found, F.array().cast("array<struct<start:int,stop:int>>"), merged)
    return F.when(F.size(found) == 0, text).otherwise(let(runs, rebuilt))


def without_secrets(
    docs: DataFrame, table: list[float] | None = None, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]"
) -> DataFrame:
    """``docs`` with every secret of the texts replaced by ``mark``; a null text becomes empty."""
    if table is None:
        table = train(labelled_strings(sample_of(docs, id_col), text_col))
    text = text_or_empty(text_col)
    clean = let(all_spans(text, table_literal(table)), lambda found: redacted(text, found, mark))
    return docs.withColumn(text_col, clean)

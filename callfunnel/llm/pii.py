"""Personal data by fixed patterns, and by a semi-Markov conditional random field for other spellings.

The base finds e-mail addresses, IP addresses, card and phone numbers by pattern and check. Around
anything that resembles one of them a window of tokens is cut into segments: a semi-Markov CRF
scores whole candidate spans (digit groups, checksums, separators, words before) and a dynamic
program over segments of at most MAX_TOKENS tokens chooses boundaries and types together, with the
base spans held in place. Spans that it adds have a posterior of at least MIN_POSTERIOR.

The field is fitted where it runs: on examples made by rule, with other spellings of each kind and
look-alikes that are none (dates, versions, prices, plain numbers), and on a bounded sample of the
corpus's own windows, in which the base spans are the truth.

Null text counts as empty: no spans. Null or repeated ids keep their rows; columns other than id
and text are not read. Patterns run in time linear in the text. Windows that meet are one window; it
is read as a stream and cut wherever no candidate segment spans the border, which changes no result.
Where candidates overlap without end, as in a table of numbers, features are held for BLOCK segments
at a time, and 16 numbers or fewer a segment are kept for the dynamic program.
"""

from __future__ import annotations

import random
import re
from array import array
from collections import deque
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callfunnel.llm.common import whole

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS, MAX_CHARS, MAX_DIGITS, MAX_GROUPS = 24, 80, 24, 8  # of an entity; the segments of the dynamic program are bounded
MIN_POSTERIOR = 0.9
SAMPLE_DOCS, SAMPLE_WINDOWS, MADE = 4000, 300, 900
BLOCK, SLICE = 1024, 64  # segments whose features are held; texts read at a time

DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def local_part(text: str, start: int, at: int) -> int:
    """Where the run of local-part characters before `at` begins, not before `start`."""
    while at > start:
        low = max(start, at - 256)
        begin = low + LOCAL.search(text[low:at]).start()
        if begin > low or low == start:
            return begin
        at = low
    return at


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start: leftmost, non-overlapping within a kind."""
    out, end = [], 0
    if "@" in text:
        for m in DOMAIN.finditer(text):
            begin = local_part(text, end, m.start())
            if begin < m.start():
                out.append((0, begin, m.end()))
                end = m.end()
    if not DIGIT.search(text):
        return out
    out += [(1, *m.span()) for m in IP.finditer(text) if all(len(n := p.lstrip("0")) <= 3 and int(n or "0") <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return out


TRIGGER = re.compile(r"[0-9](?:[^0-9A-Za-z\n]{0,3}[0-9]){6,}|[0-9]{1,3}(?:[^0-9A-Za-z\s]{1,3}[0-9]{1,3}){3}|@|[\[({]\s?at\s?[\])}]|[a-z0-9] dot [a-z]")
TOKENS = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.S)
AT, DOT = re.compile(r"[\[({ ]\s?at\s?[\])} ]"), re.compile(r"[\[({ ]\s?(?:dot|\.)\s?[\])} ]")
GROUPS = re.compile(r"[0-9]+")
PATTERNS = ("334", "1334", "3334", "2334", "4444", "465", "16", "15", "10", "422", "42222", "222", "34", "224", "13", "3321", "31531")
CUES = {"email": {"mail", "email", "contact", "write"}, "ip": {"ip", "host", "server", "address"},
        "card": {"card", "visa", "credit", "mastercard", "amex"}, "phone": {"tel", "phone", "call", "fax", "mobile", "telefon", "tél", "teléfono"}}


def windows(text: str) -> list[tuple[int, int]]:
    """Stretches around triggers, a few words to each side, apart from each other."""
    out: list[tuple[int, int]] = []
    for m in TRIGGER.finditer(text):
        low, high = max(0, m.start() - 48), min(len(text), m.end() + 48)
        gap = text.find(" ", low, m.start())
        low = gap + 1 if low and gap >= 0 else low
        gap = text.rfind(" ", m.end(), high)
        high = gap if high < len(text) and gap >= 0 else high
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def features(span: str, before: str, after: str, cue: str) -> list[float]:
    """Of a whole candidate span; `before` and `after` are the characters around it."""
    groups = GROUPS.findall(span)
    digits = "".join(groups)
    n, pattern = len(digits), "".join(str(len(g)) for g in groups)
    has_at, at_word, dot_word = "@" in span, bool(AT.search(span)), bool(DOT.search(span))
    rest = re.sub(r"[0-9]", "", span)
    mail = re.fullmatch(r"[A-Za-z0-9._%+-]+(?: ?@ ?|[\[({ ]+at[\])} ]+)[A-Za-z0-9-]+(?:(?: ?\. ?|[\[({ ]+(?:dot|\.)[\])} ]+)[A-Za-z0-9-]+)*"
                        r"(?: ?\. ?|[\[({ ]+(?:dot|\.)[\])} ]+)[A-Za-z]{2,8}", span)
    quad = len(groups) == 4 and all(len(g) < 4 and int(g) < 256 for g in groups)
    same = len(set(re.sub(r"[0-9]+", "0", span).strip("0+").split("0"))) == 1
    open_, close = span.count("("), span.count(")")
    return [
        1.0, n < 7, 7 <= n <= 8, n == 9, n == 10, n == 11, 12 <= n <= 13, n == 14, n == 15, n == 16, 17 <= n <= 19, n > 19,
        n >= 13 and luhn(digits), n >= 13 and not luhn(digits), n == 15 and digits[:2] in ("34", "37"), quad,
        quad and bool(re.fullmatch(r"[0-9]+(?:(\[\.\]|\(\.\)|\[dot\]| \. |\.)[0-9]+)(?:\1[0-9]+){2}", span)),
        *(pattern == p for p in PATTERNS), pattern not in PATTERNS, span.startswith("+"), span.startswith("00"), open_ != close, open_ == close == 1,
        has_at, at_word, dot_word, bool(mail), bool(mail) and (has_at or at_word) and (dot_word or at_word or " " in span), not has_at and bool(re.search("[A-Za-z]", rest)) and not mail,
        bool(re.search(r"[^\s().@+\-A-Za-z\[\]]", rest)), same, "  " in span or "--" in span, "-" in span, "." in span, " " in span, rest == "",
        bool(re.fullmatch(r"(?:19|20)[0-9]{2}[-/.][0-9]{1,2}[-/.][0-9]{1,2}.*", span)), ":" in span, bool(before) and before.isalnum(), bool(after) and after.isalnum(),
        before in ("+", "#", "$", "€", "%", ".", "-", "/", "=", '"', "_", ",", "(") and before != "", after in ("%", "-", ".", "/", '"', "_", "@", ":", ")") and after != "",
        *(cue in CUES[k] for k in KINDS),
    ]


K = len(features("1", "", "", ""))


def tokens(text: str, fixed: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, bool]]:
    """(start, end, inside a fixed span) of the tokens, which are also cut at the ends of `fixed` spans."""
    spans = sorted((s, e) for _, s, e in fixed if s < e)
    cuts = sorted({p for span in spans for p in span})
    c = at = reach = 0
    for m in TOKENS.finditer(text):
        start, end = m.span()
        while start < end:
            while c < len(cuts) and cuts[c] <= start:
                c += 1
            stop = min(end, cuts[c]) if c < len(cuts) else end
            while at < len(spans) and spans[at][0] < stop:
                reach, at = max(reach, spans[at][1]), at + 1
            yield start, stop, reach > start
            start = stop


def segments_from(text: str, fixed: list[tuple[int, int, int]]) -> Iterator[tuple[int, list[tuple[int, list[float]]]]]:
    """Per token, in order: its start, and the candidate segments from it as (token after the last, features).

    `fixed` spans are segments that nothing else may overlap. MAX_TOKENS tokens are looked ahead.
    """
    stream = tokens(text, fixed)
    ahead = deque(islice(stream, MAX_TOKENS))
    i, cue = 0, ""
    while ahead:
        start, stop, held = ahead[0]
        first, found, alpha = text[start], [], text[start].isalpha()
        before_cue = cue
        if alpha:
            cue = text[start:stop].lower()
        if not held and (first.isalnum() or first in "+(") and not text[start:stop].isspace():
            digits = groups = 0
            for j, (s, e, inside) in enumerate(ahead, i + 1):
                last = text[s:e]
                if inside or "\n" in last or e - start > MAX_CHARS:
                    break
                if last[0] in "0123456789":
                    digits, groups = digits + len(last), groups + 1
                    if digits > MAX_DIGITS or groups > MAX_GROUPS:
                        break
                if not last[0].isalnum():
                    continue
                span = text[start:e]
                if digits >= 7 or (digits >= 4 and first.isdigit() and last[0].isdigit() and j - i >= 7) or ((
                        "@" in span or AT.search(span)) and last.isalpha() and text[start:stop].isalnum() and ("." in span or "dot" in span)):
                    found.append((j, features(span, text[start - 1:start] if start else "", text[e:e + 1], before_cue if alpha else cue)))
        yield start, found
        ahead.popleft()
        ahead.extend(islice(stream, 1))
        i += 1


def candidates(text: str, fixed: list[tuple[int, int, int]]) -> tuple[list[int], list[tuple[int, int]], np.ndarray]:
    """Token borders of a short window; candidate segments (first token, token after the last) and their features."""
    at, segments, rows = [], [], []
    for i, (start, found) in enumerate(segments_from(text, fixed)):
        at.append(start)
        segments += [(i, j) for j, _ in found]
        rows += [x for _, x in found]
    return [*at, len(text)], segments, np.array(rows, float).reshape(-1, K)


def stretches(text: str, fixed: list[tuple[int, int, int]], w: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Token borders, segments and their scores by kind, of each stretch of overlapping candidates.

    No candidate spans the border of two stretches, so each is decoded by itself.
    """
    at, pairs, scores, rows, reach = array("i"), array("i"), [], [], 0

    def score() -> None:
        if rows:
            scores.append(np.array(rows, float) @ w.T)
            rows.clear()

    def result() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        score()
        return np.array(at), np.array(pairs).reshape(-1, 2), np.concatenate(scores)

    base = 0
    for i, (start, found) in enumerate(segments_from(text, fixed)):
        if pairs and i >= reach:
            at.append(start)
            yield result()
            at, pairs = array("i"), array("i")
            scores.clear()
        if not pairs:
            if not found:
                continue
            base = i
        at.append(start)
        for j, x in found:
            pairs.extend((i - base, j - base))
            rows.append(x)
            reach = max(reach, j)
        if len(rows) >= BLOCK:
            score()
    if pairs:
        at.append(len(text))
        yield result()


def by_end(n: int, segments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segments in order of their end, and where those of each end 0..n+1 begin."""
    order = np.argsort(segments[:, 1], kind="stable")
    return order, np.searchsorted(segments[order, 1], np.arange(n + 2))


def forward_backward(n: int, segments, score: np.ndarray) -> np.ndarray:
    """Posterior of every (segment, kind); single tokens outside segments score 0. Segments are in order of their first token."""
    if not len(segments):
        return score
    segments = np.asarray(segments)
    (first, last), total = segments.T, np.logaddexp.reduce(score, axis=1)
    order, end = by_end(n, segments)
    start = np.searchsorted(first, np.arange(n + 2))
    alpha, beta = np.zeros(n + 1), np.zeros(n + 1)
    for j in range(1, n + 1):
        alpha[j] = alpha[j - 1]
        if end[j] < end[j + 1]:
            k = order[end[j]:end[j + 1]]
            alpha[j] = np.logaddexp.reduce(np.append(alpha[j - 1], alpha[first[k]] + total[k]))
    for i in range(n - 1, -1, -1):
        beta[i] = beta[i + 1]
        if start[i] < start[i + 1]:
            k = slice(start[i], start[i + 1])
            beta[i] = np.logaddexp.reduce(np.append(beta[i + 1], beta[last[k]] + total[k]))
    around = alpha[first] + beta[last] - alpha[n]
    return np.exp(np.minimum(score + around[:, None], 0.0))


def best_path(n: int, segments, score: np.ndarray) -> list[tuple[int, int]]:
    """(segment, kind) of the highest-scoring segmentation."""
    if not len(segments):
        return []
    segments, kind, top = np.asarray(segments), score.argmax(axis=1), score.max(axis=1)
    order, end = by_end(n, segments)
    best, via = np.zeros(n + 1), np.full(n + 1, -1)
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        for k in order[end[j]:end[j + 1]]:
            value = best[segments[k, 0]] + top[k]
            if value > best[j]:
                best[j], via[j] = value, k
    out, j = [], n
    while j:
        k = int(via[j])
        if k < 0:
            j -= 1
        else:
            out.append((k, int(kind[k])))
            j = int(segments[k, 0])
    return out[::-1]


def fit(examples: list[tuple[str, list[tuple[int, int, int]]]], epochs: int = 10, rate: float = 0.2, decay: float = 2e-4) -> np.ndarray:
    """Weights (kind by feature) by AdaGrad on the conditional likelihood of the true segmentations."""
    w, seen, rng = np.zeros((len(KINDS), K)), np.full((len(KINDS), K), 1e-6), random.Random(4)
    made = []
    for text, truth in examples:
        at, segments, x = candidates(text, [])
        known = {(s, e): k for k, s, e in truth}
        gold = np.zeros((len(segments), len(KINDS)))
        for r, (i, j) in enumerate(segments):
            if (k := known.get((at[i], at[j]))) is not None:
                gold[r, k] = 1
        if len(segments):
            made.append((len(at) - 1, segments, x, gold))
    for _ in range(epochs):
        rng.shuffle(made)
        for n, segments, x, gold in made:
            g = (gold - forward_backward(n, segments, x @ w.T)).T @ x - decay * w
            seen += g * g
            w += rate * g / np.sqrt(seen)
    return w


def made_examples(count: int, seed: int = 9) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Short texts with one span of a kind, in base or other spelling, or a look-alike and none."""
    rng = random.Random(seed)
    r = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("aeioubcdfghlmnrst") for _ in range(rng.randint(2, 8)))
    pick = rng.choice

    def card(n: int, prefix: str) -> str:
        body = prefix + r(n - 1 - len(prefix))
        return next(body + c for c in "0123456789" if luhn(body + c))

    def email() -> str:
        a, d = pick((("@", "."), (" [at] ", " [dot] "), ("(at)", "."), (" at ", " dot "), (" @ ", " . "), ("[at]", "[dot]")))
        return f"{word()}{pick(('', '.' + word(), r(2)))}{a}{word()}{d}{pick(('com', 'org', 'net', 'de', 'fr'))}"

    def ip() -> str:
        return pick((".", ".", "[.]", "(.)")).join(str(rng.randint(0, 255)) for _ in range(4))

    def card_text() -> str:
        if rng.random() < 0.3:
            c = card(15, pick(("34", "37")))
            return pick((c, f"{c[:4]} {c[4:10]} {c[10:]}", f"{c[:4]}-{c[4:10]}-{c[10:]}"))
        c = card(16, pick("456"))
        return pick((c, pick(" -.").join(c[i:i + 4] for i in range(0, 16, 4))))

    def phone() -> str:
        a, b, c = str(rng.randint(200, 999)), str(rng.randint(200, 999)), r(4)
        return pick((f"+1 ({a}) {b}-{c}", f"+{rng.randint(1, 99)} {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"00{rng.randint(1, 49)} {a} {b} {c}", f"1-{a}-{b}-{c}"))

    def other() -> str:
        y, m, d = rng.randint(1900, 2040), rng.randint(1, 12), rng.randint(1, 28)
        return pick((f"{y}-{m:02}-{d:02}", f"{y}-{m:02}-{d:02} {r(2)}:{r(2)}:{r(2)}", f"{d}.{m}.{y}", f"{d}/{m}/{y}", r(rng.randint(7, 20)), f"{r(3)},{r(3)},{r(3)}", f"{r(2)}.{r(6)}", f"{r(1)}.{r(1)}.{r(2)}",
                     f"978-{r(1)}-{r(3)}-{r(5)}-{r(1)}", f"{y}-{y + 3}", f"{r(3)} {r(3)} {r(3)}", f"{r(4)} {r(4)}", f"{r(2)}:{r(2)}:{r(2)}", f"${r(3)},{r(3)}.{r(2)}", f"{r(8)}-{r(4)}", f"{r(3)}.{r(3)}.{r(3)}",
                     f"{rng.randint(300, 999)}.{r(3)}.{r(3)}.{r(3)}", f"look at {word()} dot", f"{word()} at {word()}", f"@{word()}", f"{r(5)} {r(5)} {r(5)}", f"{r(4)} {r(4)} {r(4)}", f"{r(10)}", f"{r(16)}",
                     f"{r(2)} {r(2)} {r(2)} {r(2)}", f'"{r(4)}a{r(6)}b{r(8)}"', f"v{r(1)}.{r(1)}.{r(1)}.{r(2)}", f"{r(5)}-{r(4)}", f"{r(3)}-{r(2)}-{r(4)}"))

    out = []
    for k in range(count):
        kind = (None, 0, 1, 2, 3, None)[k % 6]
        span = other() if kind is None else (email, ip, card_text, phone)[kind]()
        left = " ".join([*(word() for _ in range(rng.randint(1, 4))), *([pick(sorted(CUES[KINDS[kind]]))] if kind is not None and rng.random() < 0.2 else [])])
        lead = f"{left}{pick(('', '.', ',', ':'))} "
        out.append((f"{lead}{span}{pick(('', '.', ',', '!!'))} {word()} {word()}", [] if kind is None else [(kind, len(lead), len(lead) + len(span))]))
    return out


def added_spans(text: str, base: list[tuple[int, int, int]], w: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans of the best segmentation of each window that aren't base spans."""
    out = []
    places = sorted((s, e, k) for k, s, e in base)
    first = 0
    for low, high in windows(text):
        while first < len(places) and places[first][1] <= low:
            first += 1
        fixed, p = [], first
        while p < len(places) and places[p][0] < high:
            if places[p][1] > low:
                fixed.append((places[p][2], max(places[p][0], low) - low, min(places[p][1], high) - low))
            p += 1
        for at, segments, score in stretches(text[low:high], fixed, w):
            n = len(at) - 1
            chosen = best_path(n, segments, score)
            if chosen:
                sure = forward_backward(n, segments, score)
                out += [(kind, low + int(at[segments[k, 0]]), low + int(at[segments[k, 1]])) for k, kind in chosen if sure[k, kind] >= MIN_POSTERIOR]
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def sampled_examples(docs: DataFrame, text_col: str) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """At most SAMPLE_WINDOWS windows with base spans in them, out of about SAMPLE_DOCS documents."""
    def run(batches):
        for batch in batches:
            got = []
            for text in batch.column(0).to_pylist():
                base = base_spans(text)
                for low, high in windows(text)[:8] if base else []:
                    inside = [(k, s - low, e - low) for k, s, e in base if low <= s and e <= high]
                    if inside and high - low < 400:
                        got.append((text[low:high], joined(inside)))
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.string())], ["window", "spans"])

    every = max(1, docs.count() // SAMPLE_DOCS)
    some = docs.select(whole(docs[text_col]).alias("text")).filter(F.pmod(F.xxhash64("text"), F.lit(every)) == 0)
    rows = some.mapInArrow(run, "window string, spans string").distinct().orderBy(F.xxhash64("window"), "window", "spans").limit(SAMPLE_WINDOWS).collect()
    return [(r["window"], [(KINDS.index(k), int(s), int(e)) for k, s, e in (x.split(":") for x in r["spans"].split(","))]) for r in rows]


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, base array<struct<kind,start,end>>, added array of the same."""
    weights = docs.sparkSession.sparkContext.broadcast(fit(made_examples(MADE) + sampled_examples(docs, text_col)))
    span = "array<struct<kind: string, start: int, end: int>>"
    layout = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    shown = lambda spans: [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in sorted(spans)]

    def run(batches):
        for batch in batches:
            for part in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                both = []
                for text in map(pa.StringScalar.as_py, part.column(1)):
                    base = base_spans(text)
                    both.append((shown(base), shown(added_spans(text, base, weights.value))))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, layout) for x in zip(*both))], ["doc_id", "base", "added"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("doc_id"), whole(docs[text_col]).alias("text")).mapInArrow(run, f"doc_id {kind}, base {span}, added {span}")


def _is(kind: str):
    return lambda span: F.when(span["kind"] == kind, 1)


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, base spans by kind, their digest, and all spans."""
    place = lambda x: F.array_position(F.array(*map(F.lit, KINDS)), x["kind"])
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    every = F.transform(F.sort_array(F.transform(F.concat("base", "added"), lambda x: F.struct(place(x).alias("place"), x["start"].alias("start"), x["end"].alias("end"), x.alias("s")))), lambda x: x["s"])
    return find(docs).select(
        "doc_id", *[F.size(F.array_compact(F.transform("base", _is(k)))).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(every).alias("spans"), F.size("added").cast("long").alias("n_added"))

"""Template decontamination against a plain version that compares token lists, without hashes or joins."""

import random

import pytest
import regex

from recordlens.llm import template_decontamination as T

rng = random.Random(23)
UNITS = set(T.UNITS)


def plain_tokens(text):
    """(word, kind) per token: 1 number, 2 name, 3 unit, 0 any other word; and the kinds with names that open sentences."""
    tokens = []
    for m in regex.finditer(r"\p{L}+|\p{N}+(?:[.,]\p{N}+)*", text):
        token, before = m.group(), text[:m.start()]
        if regex.match(r"\p{N}", token):
            tokens.append([token.lower(), 1, token])
        elif token.lower() in UNITS and regex.search(r"\p{N}[\s\p{Z}]*$", before):
            tokens.append([token.lower(), 3, token])
        elif regex.match(r"\p{Lu}\p{Ll}", token) and regex.search(r"[\p{L}\p{N},;:][\s\p{Z}]+$", before):
            tokens.append([token.lower(), 2, token])
        else:
            tokens.append([token.lower(), 0, token])
    names = {t[2] for t in tokens if t[1] > 1 and regex.match(r"\p{Lu}\p{Ll}", t[2])}
    words = [t[0] for t in tokens]
    kinds = [t[1] or t[0] for t in tokens]
    named = [t[1] or ((3 if t[0] in UNITS else 2) if t[2] in names else t[0]) for t in tokens]
    return words, kinds, named


def plain_contaminated(texts, items):
    found = set()
    for item_id, item in enumerate(items):
        words, *templates = plain_tokens(item)
        n = len(words)
        if not n:
            continue
        width = min(n, T.WINDOW)
        least = max(1, min(T.LEAST_LITERAL, width - 1))
        for doc_id, text in enumerate(texts):
            doc = plain_tokens(text)
            shifts = {}
            for p in range(n - width + 1):
                told = {tuple(words[p:p + width])} | {
                    tuple(t[p:p + width]) for t in templates
                    if sum(not isinstance(k, int) for k in t[p:p + width]) >= least}
                for q in range(len(doc[0]) - width + 1):
                    if any(tuple(d[q:q + width]) in told for d in doc):
                        shifts.setdefault(q - p, set()).add(p)
            best = None
            for shift, at in shifts.items():
                size = len(at) + T.WINDOW - 1
                if not (size >= min(T.LEAST_TOKENS, n) or size >= n * T.LEAST_SHARE):
                    continue
                low, high = min(at), max(at) + width
                matched, slots, changed = 0, set(), False
                for i in range(low, high):
                    j = i + shift
                    there = [d[j] if 0 <= j < len(d) else None for d in doc]
                    here = [words[i], templates[0][i], templates[1][i]]
                    same = [a == b for a, b in zip(here, there)]
                    matched += any(same)
                    changed |= not same[0]
                    if any(s and isinstance(k, int) for s, k in zip(same[1:], here[1:])):
                        slots.add((words[i], there[0]))
                fillers = len({a for a, _ in slots})
                conflicts = len(slots) - fillers
                if conflicts <= fillers * T.MOST_CONFLICTS:
                    best = max(best or (-1,), (matched, -conflicts, n, fillers, changed))
            if best:
                found.add((doc_id, item_id, best[0], best[2], best[3], -best[1]))
    return found


WORDS = "the sold clips and how many did half as of in friends bought apples for each then gave away total cost more".split()
NAMES = ["Natalia", "Tom", "Maria", "Leo", "Åsa", "Zoë"]


def sentence():
    parts = [rng.choice([*WORDS, *WORDS, rng.choice(NAMES), str(rng.randrange(100)), f"{rng.randrange(1, 9)},{rng.randrange(100, 999)}",
                         f"{rng.randrange(50)} {rng.choice(['km', 'kg', 'hours', 'KG'])}", f"{rng.randrange(9)}km"]) for _ in range(rng.randrange(4, 16))]
    text = " ".join(parts)
    return text[0].upper() + text[1:] + rng.choice([".", "?", ", and", ":"])


def changed(item):
    out = regex.sub(r"\b\d+\b", lambda m: str(int(m.group()) + rng.choice([0, 0, 7])), item)
    for name in NAMES:
        if rng.random() < 0.4:
            out = out.replace(name, rng.choice(NAMES))
    return rng.choice([out, out.lower(), out.upper(), out.replace(" ", "\n", 3), out.replace(" ", "  ")])


@pytest.mark.parametrize("round_", range(3))
def test_equals_plain_alignment(spark, round_):
    items = [" ".join(sentence() for _ in range(rng.randrange(1, 4))) for _ in range(14)]
    items += ["42", "Tom", "12 + 7 * 3 - 4 / 2", "5 km", "the sold", "", "?!", items[0], "a b c d e f g", "x 1 y 2 z 3 w"]
    texts = ["", "42 Tom 5 km the sold", *items]
    for _ in range(60):
        parts = [sentence() for _ in range(rng.randrange(0, 4))] + [changed(rng.choice(items)) for _ in range(rng.randrange(0, 3))]
        rng.shuffle(parts)
        texts.append(" ".join(parts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = T.contaminated(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.matched_tokens, r.item_tokens, r.n_slots, r.n_conflicts) for r in got} == plain_contaminated(texts, items)
    assert len(got) > 30

"""Plain versions of the corpus operators, over lists in memory."""

from __future__ import annotations

import collections
import random
import re

WORDS = "ter vin sola qu mar eton dri osk plen ula fir nost bek ald ir sum ket wor zan lep".split()
LICENSE = "Licensed under the Apache License, Version 2.0."
ITEM = "one item of the test that no clean text may ever hold in full length"


def prose(rng: random.Random, n: int) -> str:
    words = ["".join(rng.choice(WORDS) for _ in range(rng.randint(1, 3))) for _ in range(n)]
    return " ".join(w.capitalize() + "." if rng.random() < 0.1 else w for w in words)


def documents() -> list[tuple]:
    """(doc_id, text, lang, source): copies, near copies, a shared passage, licenses, NULLs, one very long text."""
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randint(20, 200)), rng.choice(["en", "fr"]), "a") for i in range(40)]
    copied, passage = rows[3][1], prose(rng, 60)
    rows += [(40 + i, copied, "en", "hot") for i in range(12)]
    for i in range(12):
        words = rows[5][1].split()
        words[rng.randrange(len(words))] = f"edit{i}"
        rows.append((60 + i, " ".join(words), "fr", "hot"))
    rows += [(80 + i, prose(rng, 30) + "\n" + passage + "\n" + prose(rng, 30), "en", "b") for i in range(8)]
    rows += [
        (100, None, None, None),
        (101, "", "en", "a"),
        (102, " \n\t ", "en", "a"),
        (103, "one two", "en", "a"),
        (104, "One  Two", "en", "a"),
        (105, prose(rng, 20_000), "fr", "long"),
        (106, LICENSE + " All Rights\nreserved, all rights reserved! CC-BY and cc by", "en", "a"),
        (107, "The GNU General\nPublic license " + prose(rng, 10), "en", "a"),
        (108, "ab" * 300, "en", "a"),
        (109, "x" * 150 + " É ß 漢字 ▁ ́ " + "x" * 150, "en", "a"),
        (110, prose(rng, 50) + " " + ITEM + ". " + prose(rng, 50), "en", "a"),
        (111, "12 34 !!", "en", "a"),
        (112, passage, "en", "b"),
        (113, rows[7][1], "en", "a"),
        (113, rows[7][1], "en", "a"),
        (None, rows[8][1], "en", "a"),
        (-5, rows[9][1] + " tail", "fr", "a"),
    ]
    return rows


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text: str | None) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def groups(rows: list[tuple]) -> dict:
    """id: (set size, smallest id reachable) of rows (id, text) with an id."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def kept_bytes(texts: list[str | None], length: int = 100) -> list[tuple[bytes, int, int]]:
    """(bytes left, bytes removed, maximal removed runs) of texts in order."""
    seen, out = set(), []
    for text in texts:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if raw[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(raw[p : p + length])
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((bytes(c for c, g in zip(raw, gone, strict=True) if not g), sum(gone), spans))
    return out


def phrase_places(text: str | None, phrases: dict[str, str]) -> tuple[int, list[tuple[int, str]]]:
    """(number of words, [(start, label)]) of consecutive words."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    found = []
    for phrase, label in phrases.items():
        wanted = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
    return len(words), sorted(found)


def license_labels(text: str | None, templates) -> set[str]:
    """Labels of templates of which some block of words holds enough."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    found = set()
    for t in templates:
        for i in range(len(words)):
            block = set(words[i : i + t.width])
            if len(block & set(t.distinct)) >= t.need and block >= set(t.named) and not block & set(t.barred):
                found.add(t.label)
    return found


def contained(rows: list[tuple], items: list[tuple], least: float = 0.8) -> set[tuple]:
    """(id, item, shared) of the items whose shingles a text holds."""

    def of(text):
        words = re.findall(r"[^\W_]+", (text or "").lower())
        if len(words) < 5:
            return {tuple(words)} if words else set()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    tests = {i: of(t) for i, t in items}
    out = collections.defaultdict(int)
    for i, text in rows:
        own = of(text)
        for item, wanted in tests.items():
            if wanted and len(own & wanted) >= least * len(wanted) - 1e-9:
                out[i, item] = max(out[i, item], len(own & wanted))
    return {(*k, v) for k, v in out.items()}


def paragraphs(text: str | None) -> set[bytes]:
    """Lines cut at sentence ends; of what is longer than 256 bytes, pieces that end after selected bytes."""
    found = set()
    for part in re.split(r"\n+|(?<=[.!?])\s+|(?<=[\u3002\uFF01\uFF1F])\s*", text or "", flags=re.ASCII):
        raw = part.encode()
        begin = 0
        if len(raw) <= 256:
            found |= {raw} if raw else set()
            continue
        while begin < len(raw):
            end = begin + 35
            while end <= min(begin + 512, len(raw)) and [b & 3 for b in raw[end - 3 : end]] != [1, 2, 3]:
                end += 1
            end = end if end <= min(begin + 512, len(raw)) else min(begin + 512, len(raw))
            found.add(raw[begin:end])
            begin = end
    return found


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0

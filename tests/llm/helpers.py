"""Small tables with all the odd cases, and brute-force statements of what the operators do."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, set_key string, key string, score double"


def odd_docs(seed: int = 1) -> list[tuple]:
    """Null ids, texts and sources; empty and blank texts; repeated rows and ids; copies and near copies; a very
    long text; columns with names that the operators use themselves."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    base, passage = text(120), text(60)
    near = base.split()
    near[7] = "changed"
    texts = [
        (1, base), (2, base), (3, " ".join(near)), (4, passage + "\n" + text(50)), (5, text(40) + " " + passage + " " + text(9)),
        (6, ""), (7, None), (8, "  \t\n "), (None, base), (9, "one two"), (10, "one two"), (11, text(4000)), (12, "aaaa" * 200),
        (12, "aaaa" * 200), (13, "Zoë naïve — ünïcode ΑΣ İ <|endoftext|> x <|startoftext|>  two  spaces\r\n\x1cend "), (14, "ab" * 90 + " ab" * 90),
        (15, text(30)), (15, text(30)), (None, None), (16, "Licensed under the Apache License, Version 2.0.\n" + text(20)), (17, "x"),
    ]
    return [(i, t, "en", None if k % 5 == 0 else f"s{k % 3}", len(t or ""), "k", "v", 0.1) for k, (i, t) in enumerate(texts)]


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)

"""Small texts for the operators' tests."""

import random

WORDS = "the of and to in is that for was with on stone river light paper cloud garden window street bread".split()


def prose(seed: int, words: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + (str(pick.randint(0, 400)) if pick.random() < 0.5 else "") for _ in range(words))


def edited(text: str, seed: int, edits: int) -> str:
    pick, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[pick.randrange(len(words))] = f"new{pick.randint(0, 99)}"
    return " ".join(words)


def rows() -> list[tuple]:
    """Nulls, empty and one-word texts, copies, near copies, a long text, repeated rows."""
    base = prose(1, 120)
    texts = [None, "", " \n\t", "one", "one", "ONE", "a b c", base, base, base.upper(), edited(base, 2, 1),
             edited(base, 3, 2), edited(base, 4, 12), prose(5, 3000), prose(6, 60), base + " " + prose(7, 90)]
    out = [(i, t, "en", f"src{i % 3}") for i, t in enumerate(texts)]
    return [*out, out[7], (None, base, None, None), (None, None, None, None)]

"""Documents that operators must handle."""

import random

WORDS = "the of and to in is that for with as on by at from this are be or an not house river stone garden window market paper light".split()


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + pick.choice(["", "", "s", "ed", "ing", str(pick.randrange(50))]) for _ in range(n))


#: Nulls, empty and blank texts, a very long one, ties and repeated rows, copies, and characters of every width.
AWKWARD = [
    (1, prose(1, 80)),
    (2, prose(1, 80)),
    (3, prose(1, 79) + " changed"),
    (3, prose(1, 79) + " changed"),
    (3, prose(9, 60)),
    (None, prose(1, 80)),
    (None, None),
    (4, None),
    (5, ""),
    (6, " \n\t "),
    (7, "word"),
    (8, "two words"),
    (9, "ünïcödé 漢字 \U0001f600 " * 30),
    (10, prose(4, 20000)),
    (11, "a" * 5000),
    (12, prose(5, 40) + prose(4, 60) + prose(6, 40)),
    (13, "\0 zero \x1c bytes \r\n" * 20),
]

"""Marks that move before their letter, against moving them one by one."""

import random
import re
import time

from folioloom.functions.text import moved_back


def one_by_one(t, mark, code, signs):
    late = re.compile(f"(.)([{re.escape(signs)}]?){re.escape(mark)}" if signs else f"(.)(){re.escape(mark)}", re.S)
    while m := late.search(t):
        t = t[: m.start()] + code + m[1] + m[2] + t[m.end() :]
    return t


def test_one_pass_is_one_by_one():
    rng = random.Random(1)
    for _ in range(3000):
        t = rng.choice("kij \n") + "".join(rng.choices("kijZ \n", k=rng.randint(0, 12)))
        for code in ("r", "rx", ""):
            for signs in ("", "i", "ij"):
                assert moved_back(t, "Z", code, signs) == one_by_one(t, "Z", code, signs), (t, code, signs)
    assert moved_back("Zk", "Z", "r", "") == "Zk" and moved_back("", "Z", "r", "") == ""
    assert moved_back("kabi", "ab", "r", "i") == "rki"


def test_long_texts_in_time():
    begun = time.process_time()
    assert len(moved_back("kiZ" * 300_000, "Z", "rx", "i")) == 1_200_000
    assert time.process_time() - begun < 10

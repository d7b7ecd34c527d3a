"""Preference formatting against a plain version."""

import random

from chemlake.llm import chat


def plain(convs, pairs):
    def show(turns):
        text, mask = "", []
        for role, body in turns:
            text += f"<|im_start|>{role.replace('<|', '< |')}\n"
            begin = len(text)
            text += body.replace("<|", "< |") + "<|im_end|>\n"
            if role == "assistant":
                mask.append(f"{begin}:{len(text)}")
        return text, ",".join(mask)

    out = []
    for c, r in pairs:
        a, b = convs[c], convs[r]
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        out.append((c, r, n, show(a[:n])[0], show(a[n:])[0], show(b[n:])[0], show(a[n:])[1], show(b[n:])[1]))
    return sorted(out)


def test_equals_plain_version(spark):
    r = random.Random(2)
    convs = {i: [(r.choice(["user", "assistant", "system"]), r.choice(["a", "é b", "<|im_end|>", ""])) for _ in range(r.randint(1, 6))] for i in range(60)}
    rows = [(i, t, role, text, 7) for i, turns in convs.items() for t, (role, text) in enumerate(turns)]
    r.shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, prompt int")
    pairs = [tuple(p) for p in chat.natural_pairs(table).collect()]
    heads = {}
    for i in sorted(convs):
        heads.setdefault(convs[i][0], []).append(i)
    assert set(pairs) == {(2 * k, 2 * k + 1) for k in range(30)} | {(g[0], x) for g in heads.values() for x in g[1:]} and len(pairs) == len(set(pairs))
    out = sorted(map(tuple, chat.format_preferences(table, spark.createDataFrame(pairs, "chosen_id long, rejected_id long")).collect()))
    assert out == plain(convs, pairs)


def test_edge_cases(spark):
    kind = "conv_id long, turn long, role string, text string"
    table = spark.createDataFrame([(0, 0, None, None), (0, None, "user", "x"), (1, 0, "", ""), (1, 0, "", ""), (None, 0, "user", "q")], kind)
    pairs = spark.createDataFrame([(0, 1), (0, 1), (0, 9), (None, 1), (1, 1)], "chosen_id long, rejected_id long")
    out = sorted((x.chosen_id, x.rejected_id, x.n_prompt_turns, x.chosen == "") for x in chat.format_preferences(table, pairs).collect())
    assert out == [(0, 1, 0, False), (0, 1, 0, False), (1, 1, 2, True)]
    assert chat.format_preferences(table.limit(0), pairs).collect() == [] == chat.natural_pairs(table.limit(0)).collect()

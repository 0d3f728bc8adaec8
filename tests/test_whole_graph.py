"""The whole graph over conversations against a plain fold in Python."""

import re

from voxloom.plans import queries

SF = "/root/testdata/sf0.001"


def utterances(rows):
    """file -> (idx, st, en, spk, text): turns cut at commas, 15 characters to the second."""
    files = {}
    for conv, _, role, text in sorted(rows):
        own = files.setdefault(conv, [])
        for part in text.split(", "):
            st = own[-1][4] if own else 0
            own.append((len(own), st / 15.0, (st + len(part)) / 15.0, role, st + len(part), part))
    return {f: [(i, st, en, spk, t) for i, st, en, spk, _, t in own] for f, own in files.items()}


def merged(own, cap=25.0):
    out = []
    for _, st, en, spk, text in own:
        text = text.strip()
        if not text:
            continue
        prev = out[-1] if out else None
        if prev and prev[2] == spk and (prev[1] - prev[0]) + (en - st) <= cap and prev[3][-1] not in ".?!":
            prev[1], prev[3] = max(prev[1], en), f"{prev[3]} {text}"
        else:
            out.append([st, en, spk, text])
    return out


def split(own, cap=25.0):
    for st, en, spk, text in own:
        parts = re.split(r"(?<=[.?!])\s+", text)
        total = sum(map(len, parts))
        if en - st <= cap or len(parts) <= 1:
            yield st, en, spk, text
            continue
        held, size, begin = [], 0, st
        for p in parts:
            if held and begin + (size + len(p)) / total * (en - st) - begin > cap:
                until = begin + size / total * (en - st)
                yield begin, until, spk, " ".join(held)
                held, size, begin = [], 0, until
            held.append(p)
            size += len(p)
        yield begin, en, spk, " ".join(held)


def packed(own, cap=25.0, most=4):
    samples, length, who = [], 0.0, set()
    for u in own:
        st, en, spk, _ = u
        if not samples or length + (en - st) > cap or len(who | {spk}) > most:
            samples.append([])
            length, who = 0.0, set()
        samples[-1].append(u)
        length += en - st
        who.add(spk)
    return samples


def rendered(sample):
    number, lines, last = {}, [], None
    for _, _, spk, text in sample:
        k = number.setdefault(spk, len(number))
        if k == last:
            lines[-1] += f" {text.strip()}"
        else:
            lines.append(f"Speaker {k}: {text.strip()}")
        last = k
    return "\n".join(lines)


def test_pipeline_e2e(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {}
    for f, own in utterances(rows).items():
        for n, sample in enumerate(packed(split(merged(own)))):
            want[f, n] = (rendered(sample), round(max(0.0, max(u[1] for u in sample) - min(u[0] for u in sample)), 6), len(sample))
    got = {(r.file, r.sample): (r.text, round(r.duration, 6), r.n) for r in queries.QUERIES["pipeline_e2e"](spark, SF).collect()}
    assert got == want and len(want) > 50

"""Sessions, the conversation trie and license scans against brute force and DuckDB."""

import datetime as dt
import hashlib
import math
import os
import random
import re
import zlib

import pytest

from leadlink.llm import licenses, prefixes, registry, sessions

CLICKS = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, run string, cell string, n string"
TURNS = "conv_id long, turn long, role string, text string, d string, t string, n string"
EPOCH = dt.datetime(1970, 1, 1)
MIN = 60_000_000


def brute_sessions(rows):
    best = {}
    order = lambda r: tuple((x is not None, x) if x is not None else (False, 0) for x in (r[1], r[3], r[2], r[4], r[5]))
    for r in rows:
        if r[3] is not None and r[1] is not None and (r[0] not in best or order(r) < order(best[r[0]])):
            best[r[0]] = r
    us = lambda t: (t - EPOCH) // dt.timedelta(microseconds=1)
    clients = {}
    for r in best.values():
        late = r[2] is not None and us(r[2]) - us(r[1]) > 15 * MIN
        final = r[4] in ("purchase", "signup") and r[5] is not None and r[5] >= 60
        cents = math.floor(100 * r[5] + 0.5) if r[5] is not None and math.isfinite(r[5]) else 0
        clients.setdefault(r[3], []).append((us(r[1]), r[0] if r[0] is not None else -(10**9), late, final, cents))
    out = set()
    for client, clicks in clients.items():
        timely, lates = sorted(c for c in clicks if not c[2]), [c for c in clicks if c[2]]
        found = []
        for c in timely:
            prev = found[-1][0][-1] if found else None
            reason = None
            if prev:
                reason = "end" if prev[3] else "gap" if c[0] - prev[0] >= 15 * MIN else "length" if c[0] - found[-1][0][0][0] > 60 * MIN else None
            if prev is None or reason:
                if found:
                    found[-1][1] = reason
                found.append([[], None])
            found[-1][0].append(c)
        for i, (own, reason) in enumerate(found):
            nxt = found[i + 1][0][0][0] if i + 1 < len(found) else None
            n_late = sum(1 for x in lates if own[0][0] <= x[0] and (nxt is None or x[0] < nxt))
            path = hashlib.sha256(",".join(str(c[1]) for c in own).encode()).hexdigest()
            out.add((client, own[0][1], own[0][0], own[-1][0], len(own), n_late, sum(c[4] for c in own), reason or ("end" if own[-1][3] else "none"), path))
    return out


def run_sessions(spark, rows, tmp_path):
    spark.createDataFrame([(*r, "x", "y", None) for r in rows], CLICKS).write.parquet(f"{tmp_path}/clicks.parquet")
    got = sessions.op13(spark, str(tmp_path)).collect()
    names = ["client_id", "session_id", "start_us", "end_us", "n_clicks", "n_late", "value_cents", "closed_by", "path_sha256"]
    assert len(got) == len({tuple(r[n] for n in names) for r in got})
    return {tuple(r[n] for n in names) for r in got}


def clicks(seed, n=900):
    """Dense and sparse clients, ties, whole minutes (so that limits are met), repeats, late rows, nulls."""
    rng, rows, t0 = random.Random(seed), [], dt.datetime(2024, 3, 30, 22)
    for i in range(n):
        client = rng.choice([1, 1, 1, 1, 2, 3, None] if i % 9 else [4, 5])
        step = dt.timedelta(minutes=rng.randrange(0, 900 if client in (1, 2) else 4000))
        ts = t0 + step + dt.timedelta(microseconds=rng.choice([0, 0, 0, 1, -1]))
        arrived = ts + rng.choice([dt.timedelta(0), dt.timedelta(minutes=15), dt.timedelta(minutes=15, microseconds=1), dt.timedelta(minutes=1)])
        kind = rng.choice(["view", "click", None, "purchase", "signup"]) if client != 1 or i % 7 == 0 else "view"
        value = rng.choice([None, 60.0, 59.99, 1.005, -3.25, 480.0, float("inf")])
        row = (i, None if rng.random() < 0.03 else ts, None if rng.random() < 0.05 else arrived, client, kind, value)
        rows += [row] * rng.choice([1, 1, 1, 2])
    return rows


@pytest.mark.parametrize("seed", [1, 2, 4])
def test_sessions(spark, tmp_path, seed):
    rows = clicks(seed)
    got = run_sessions(spark, rows, tmp_path)
    assert got == brute_sessions(rows)
    assert {r[7] for r in got} == {"end", "gap", "length", "none"} and any(r[5] for r in got)


def test_sessions_long_run(spark, tmp_path):
    """One client, a click every few minutes for days without a final one: many sessions by length."""
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(minutes=5 * i), t0 + dt.timedelta(minutes=5 * i), 7, "view", 1.0) for i in range(1500)]
    rows += [(5000 + i, t0 + dt.timedelta(minutes=3 * i), None, 8, "view", None) for i in range(400)]
    got = run_sessions(spark, rows, tmp_path)
    assert got == brute_sessions(rows) and sum(r[7] == "length" for r in got) > 100


def test_sessions_zone(spark, tmp_path):
    """Times without a zone are taken as they are, whatever the session's zone is."""
    rows = clicks(3, 200)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert run_sessions(spark, rows, tmp_path) == brute_sessions(rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_sessions_empty(spark, tmp_path):
    assert run_sessions(spark, [], tmp_path / "a") == set()
    assert run_sessions(spark, [(1, None, None, 1, None, None), (2, EPOCH, None, None, None, None)], tmp_path / "b") == set()


def test_sessions_ids(spark, tmp_path):
    """A null click_id counts as one; of rows that share an id one counts, the same one whenever it is run."""
    t = dt.datetime(2024, 1, 1)
    rows = [(None, t, t, 1, "view", 1.0), (None, t + dt.timedelta(minutes=1), t, 1, "view", 2.0), (3, t, t, 1, "purchase", 60.0), (3, t + dt.timedelta(hours=1), t, 2, "view", 1.0), (4, t, t, 1, None, None)]
    run = lambda rows: sorted((r.session_id or 0, r.n_clicks, str(r.clicks), r.closed_by) for r in sessions.sessions(spark, spark.createDataFrame([(*r, "x", "y", None) for r in rows], CLICKS)).collect())
    got = run(rows)
    assert got == run(rows[::-1]) and sum(n for _, n, _, _ in got) == 3


# ---- conversations ----
def brute_trie(rows):
    convs = {}
    key = lambda r: hashlib.md5(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).digest()
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, key(r))):
        convs.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        built[c] = tuple(convs.get(base, [])[:h]) + tuple(own[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = {}
    for path in sorted(members, key=len, reverse=True):
        m = sorted(members[path])
        kids = [out[p] for p in members if len(p) == len(path) + 1 and p[:-1] == path]
        ends = ",".join(str(c) for c in m if len(built[c]) == len(path))
        saved = (len(m) - 1) * (len(path[-1][1]) if path else 0) + sum(k[6] for k in kids)
        parent = min(members[path[:-1]]) if path else None
        out[path] = (m[0], len(path), parent, len(m), len(kids), sum(k[5] for k in kids) or 1, saved, hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=str)


def run_trie(spark, rows):
    got = prefixes.trie(spark, spark.createDataFrame([(*r, "a", "b", None) for r in rows], TURNS))
    assert got.columns == prefixes.OUT
    return sorted((tuple(r) for r in got.collect()), key=str)


def turns(seed):
    """Shared beginnings, whole copies, one long conversation and its copies, nulls, ties, repeated rows."""
    rng, rows = random.Random(seed), []
    for c in [*range(-205, -190), *range(0, 60), *range(300, 330), 401, 402, 10**12 + 7]:
        kind = rng.random()
        if kind < 0.2:
            rows += [(c, i, "user", f"same {i}") for i in range(8)]
        elif kind < 0.3:
            rows += [(c, rng.choice([None, 1, 1, 2]), rng.choice([None, "user"]), rng.choice([None, "", "é𝄞", "x"])) for _ in range(5)]
        else:
            rows += [(c, i, rng.choice(["user", "bot"]), rng.choice(["a", "bb", f"own {c}"])) for i in range(rng.randrange(1, 9))]
    for c in (501, 502, 503, 504):
        rows += [(c, i, "user", f"long {i}" if c != 504 or i < 12 else f"other {i}") for i in range(40)]
    return rows + rows[:6] + [(None, 1, "user", "nobody")]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie(spark, seed):
    rows = turns(seed)
    assert run_trie(spark, rows) == brute_trie(rows)


def test_trie_blocks_of_ids(spark):
    """Members of one class over several blocks of ids are hashed in ascending order."""
    rows = [(c, 0, "user", "hi") for c in (*range(-9000, 9001, 700), 5, 6)]
    assert run_trie(spark, rows) == brute_trie(rows)


def test_trie_empty(spark):
    assert run_trie(spark, []) == []
    assert run_trie(spark, [(None, 1, "user", "x")]) == []
    assert run_trie(spark, [(7, 1, "user", "x")]) == brute_trie([(7, 1, "user", "x")])


# ---- licenses ----
def brute_licenses(text, templates=licenses.TEMPLATES, containment=licenses.CONTAINMENT):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    spots = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    best, more = 0.0, set()
    for c in licenses.classes(templates, containment):
        half = c["longest"]
        for k in range(max(len(w) - half - 1, 0) // half + 1):
            block = set(w[k * half : (k + 2) * half])
            for _, label, own in c["sets"]:
                share = len(block & set(own)) / len(own)
                if len(block & set(own)) >= math.ceil(containment * len(own) - 1e-9):
                    best, more = max(best, share), more | {label}
    at = [i for i, _ in spots]
    base = {x for _, x in spots}
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if at else best)


def license_texts():
    rng = random.Random(5)
    notices = [t for _, t in licenses.TEMPLATES]
    filler = "the of to and in license permission this under copyright free software any work that is by international x y z".split()
    out = [None, "", "  \n", "CC-BY cc by\ncc,by", "General\tPublic--LICENSE", "all rights reserved all rights reserved", "ALL RIGHTS", "naïve Éa 4.0 ſ"]
    for n in notices:
        words = n.split()
        out += [n, " ".join(words[:-1]), " ".join(reversed(words)), "\n".join(words)]
        for at in (0, 7, 30, 65, 200):
            out.append(" ".join(rng.choices(filler, k=at)) + " " + n.upper() + " " + " ".join(rng.choices(filler, k=50)))
    out += [" ".join(rng.choices(filler, k=rng.randrange(1, 400))) for _ in range(60)]
    return [*out, " ".join(rng.choices(filler, k=150_000)) + " " + notices[2], *out[:5]]


@pytest.mark.parametrize("containment", [0.9, 0.6, 1.0])
def test_licenses(spark, docs, containment):
    texts = license_texts()
    ids = [None if i % 17 == 0 else i // 2 for i in range(len(texts))]
    found, blocks = licenses.scan(spark, docs(texts, ids), containment=containment)
    got = [tuple(r) for r in found.collect()]
    want = [(i, *brute_licenses(t, containment=containment)) for i, t in zip(ids, texts)]
    shown = lambda rows: sorted(str((*r[:-1], round(r[-1], 9))) for r in rows)
    assert shown(got) == shown(want)
    for b in blocks.collect():
        assert b.start < b.end and containment - 1e-9 <= b.containment <= 1 and b.shared > 0


def test_licenses_without_templates(spark, docs):
    found, blocks = licenses.scan(spark, docs(["all rights reserved", "x"]), templates=[])
    assert blocks.isEmpty() and sorted(r.labels for r in found.collect()) == ["", "reserved"]
    found, blocks = licenses.scan(spark, docs([]))
    assert found.isEmpty() and blocks.isEmpty()


@pytest.mark.parametrize("name", ["op11_conversation_trie", "op12_license_scan", "op13_gap_sessions"])
def test_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no test tables")
    c = duckdb.connect()
    for t in ("conversations", "documents", "clicks"):
        c.sql(f"create view {t} as select * from '{d}/{t}.parquet'")
    mine, other = registry.QUERIES[name](spark, d), c.sql(registry.SQL[name])
    assert sorted(mine.columns) == sorted(other.columns)
    names = sorted(mine.columns)
    shown = lambda rows: sorted(str(tuple(f"{v:.9f}" if isinstance(v, float) else v for v in r)) for r in rows)
    assert shown(mine.select(*names).collect()) == shown(other.select(*names).fetchall())

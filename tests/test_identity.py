"""Identity rules against brute force, frozen similarities, components on random graphs."""

import random
from collections import Counter, defaultdict

import pytest

from leadlake.functions import similarity
from leadlake.operators import components, identity, skew

SCHEMA = ("lead_id string, source string, full_name string, email string, email_domain string, job_title string, "
          "seniority string, company_name string, company_domain string, industry string, employee_count int, "
          "apollo_score double")


def lead(i, name, email, company="Acme", source="apollo", score=1.0, **more):
    domain = email.split("@")[1] if email and "@" in email else None
    row = dict(lead_id=f"l{i:04d}", source=source, full_name=name, email=email, email_domain=domain, job_title=None,
               seniority="vp", company_name=company, company_domain=None, industry=None, employee_count=5, apollo_score=score)
    row.update(more)
    return tuple(row.values())


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def ratio(a, b):
    """Plain dynamic program, independent of the bit-parallel one."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], (last + 1 if x == y else max(row[j], row[j - 1]))
    total = len(a) + len(b)
    return (1 - (total - 2 * row[-1]) / total) * 100 if total else 100.0


def tokens(text):
    return " ".join(sorted((text or "").replace("None", "").lower().strip().replace(".", "").replace(",", "").split()))


def brute_force(rows):
    """Matching record pairs as the rules state them."""
    pairs = []
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            e = [(r[3] or "").lower().strip() if r[3] != "None" else "" for r in (rows[i], rows[j])]
            d = [x.split("@")[1] if "@" in x else "" for x in e]
            n, c = ([tokens(r[k]) for r in (rows[i], rows[j])] for k in (2, 7))
            s = ratio(*n) if all(n) else 0
            if e[0] and e[0] == e[1]:
                pairs.append((i, j, "exact_email", 100))
            elif d[0] and d[0] == d[1] and s >= 85:
                pairs.append((i, j, "domain_name_fuzzy", int(s * 0.9)))
            elif all(n) and all(c) and s >= 90 and ratio(*c) >= 90:
                pairs.append((i, j, "company_name_fuzzy", 75))
    return pairs


def clusters_of(count, pairs):
    root = list(range(count))
    for i, j, *_ in pairs:
        a, b = root[i], root[j]
        root = [a if r == b else r for r in root]
    return Counter(Counter(root).values())


def random_rows(seed, count):
    rnd = random.Random(seed)
    first = ["ann", "anna", "bob", "bobby", "carla", "karla", "alexander", "alexandra", "li", "x"]
    last = ["miller", "millar", "smith", "smyth", "johnson", "jonson", "johnsson", "o.neill", "oneill", "y"]
    rows = []
    for i in range(count):
        name = rnd.choice([f"{rnd.choice(first)} {rnd.choice(last)}", f"{rnd.choice(last)}, {rnd.choice(first)}", None, "None"]
                          + [f" {rnd.choice(first)} {rnd.choice(first)}  {rnd.choice(last)}"] * 3)
        host = rnd.choice(["gmail.com"] * 4 + ["acme.com", "corp.io", "bolt.org"])
        email = rnd.choice([None, "None", "no-at", f"a{rnd.randrange(8)}@{host}"] + [f"u{i}@{host}"] * 4)
        company = rnd.choice(["Acme Inc", "Acme, Inc.", "ACME Inc 2", "Bolt Company", "Bolt Compani", None, "None", ""])
        rows.append(lead(i, name, email, company, rnd.choice(["apollo", "hubspot"]), float(rnd.randrange(5))))
    return rows


@pytest.mark.parametrize("a, b, score", [
    ("alice johnson", "johnson alice", 100.0), ("alice johnson", "alice jonson", 96.0), ("alice johnson", "alice j", 70.0)])
def test_frozen_similarities(a, b, score):
    x, y = tokens(a), tokens(b)
    total = len(x) + len(y)
    assert round((1 - (total - 2 * similarity.lcs_length(x, y)) / total) * 100) == score


def test_lcs_agrees_with_plain_program():
    rnd = random.Random(1)
    for _ in range(500):
        a, b = ("".join(rnd.choice("abc é") for _ in range(rnd.randrange(90))) for _ in range(2))
        total = len(a) + len(b)
        if total:
            assert (1 - (total - 2 * similarity.lcs_length(a, b)) / total) * 100 == ratio(a, b)


@pytest.mark.parametrize("threshold", [85, 90])
def test_filters_lose_no_pair(threshold):
    """Block keys and bit signature keep every pair that reaches the threshold."""
    rnd = random.Random(threshold)
    share, hits = round(1 - threshold / 100, 10), 0
    for _ in range(6000):
        letters = rnd.choice(["ab", "abcdefghij"])
        a = "".join(rnd.choice(letters) for _ in range(rnd.choice([1, 2, 5, 8, 13, 16, 17, 20, 24, 25, 26, 33, 60])))
        chars = list(a)
        for _ in range(rnd.randint(0, max(1, len(a) // 4))):
            place = rnd.randrange(len(chars) + 1)
            chars[place:place + rnd.randrange(2)] = rnd.choice(letters) * rnd.randrange(2)
        b = "".join(chars)
        if b and ratio(a, b) >= threshold:
            hits += 1
            short, long = sorted((a, b), key=len)
            assert set(similarity.keys_of(short, share, "short")) & set(similarity.keys_of(long, share, "long"))
            edits = len(a) + len(b) - 2 * similarity.lcs_length(a, b)
            assert (similarity.signature_of(a) ^ similarity.signature_of(b)).bit_count() <= edits
    assert hits > 1000


def check_against_brute_force(spark, rows):
    pairs = brute_force(rows)
    leads = frame(spark, rows)
    log = Counter()
    for r in identity.match_log(leads).collect():
        log[r.match_type, r.confidence] += r.pair_count
    assert log == Counter((kind, confidence) for _, _, kind, confidence in pairs)
    sizes = Counter(r.record_count for r in identity.golden_records(leads).collect())
    assert sizes == clusters_of(len(rows), pairs)


@pytest.mark.parametrize("seed", [1, 2])
def test_resolution_equals_brute_force(spark, seed):
    check_against_brute_force(spark, random_rows(seed, 250))


def test_hot_paths_equal_brute_force(spark, monkeypatch):
    """Every key hot."""
    monkeypatch.setattr(skew, "HOT_ROWS", 2)
    monkeypatch.setattr(skew, "HOT_SHARE", 10**9)
    check_against_brute_force(spark, random_rows(3, 200))


def test_one_record_and_one_domain_hold_a_third_each(spark):
    rows = [lead(i, "Ann Copy", "ann@copy.com") for i in range(60)]
    rows += [lead(100 + i, f"person {i * 7919}", f"p{i}@gmail.com", f"firm {i * 104729}") for i in range(60)]
    rows += random_rows(4, 60)
    check_against_brute_force(spark, rows)


@pytest.mark.parametrize("threshold, count", [(75, 1), (76, 2), (90, 2), (95, 4), (101, 5)])
def test_threshold(spark, threshold, count):
    rows = [lead(0, "Ann Lee", "a@x.com"), lead(1, "Ann Lee", "a@x.com"), lead(2, "Lee Ann", "b@x.com"),
            lead(3, "Ann Lee", "c@y.com"), lead(4, "Ann Lee", "d@y.com")]
    assert identity.golden_records(frame(spark, rows), threshold=threshold).count() == count


def test_golden_record(spark):
    rows = [lead(0, "Alice J", "alice@test.com", "TechCorp", "apollo", 80.0, employee_count=0, job_title="None"),
            lead(1, "Alice Johnson", "alice@test.com", "TechCorp", "hubspot", 90.0, employee_count=0, job_title=""),
            lead(2, "A", "alice@test.com", None, None, None, employee_count=7, job_title="cto")]
    row = identity.golden_records(frame(spark, rows)).collect()
    assert len(row) == 1
    row = row[0]
    assert (row.full_name, row.email, row.company_name, row.employee_count, row.job_title) == (
        "Alice Johnson", "alice@test.com", "TechCorp", 7, "cto")
    assert (row.sources, row.source_count, row.record_count, row.apollo_score) == ("apollo,hubspot,unknown", 3, 3, 90.0)


def test_records_that_match_nothing_stay_apart(spark):
    rows = [lead(0, None, None, None), lead(0, None, None, None), lead(1, "Ann", None, None)]
    golden = identity.golden_records(frame(spark, rows)).collect()
    assert [r.record_count for r in golden] == [1, 1, 1]
    assert identity.resolution_stats(identity.golden_records(frame(spark, rows[:0]))).first().golden_records == 0


def expected_components(edges):
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    seen, out = set(), {}
    for start in sorted(near):
        if start in seen:
            continue
        stack, group = [start], set()
        while stack:
            node = stack.pop()
            if node not in group:
                group.add(node)
                stack.extend(near[node])
        seen |= group
        out.update({node: min(group) for node in group})
    return out


GRAPHS = {
    "empty": [],
    "loops": [(1, 1), (2, 2)],
    "chain": [(i, i + 1) for i in range(60)],
    "star": [(0, i) for i in range(1, 80)] + [(99, i) for i in range(100, 180)],
    "cliques": [(a, b) for k in (0, 20) for a in range(k, k + 8) for b in range(k, k + 8)] + [(3, 22)],
    "random": [(random.Random(i).randrange(200), random.Random(i + 999).randrange(200)) for i in range(120)],
}


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, monkeypatch, name, hot):
    if hot:
        monkeypatch.setattr(skew, "HOT_ROWS", 3)
        monkeypatch.setattr(skew, "HOT_SHARE", 10**9)
    edges = spark.createDataFrame(GRAPHS[name], "src long, dst long")
    found = components.connected_components(edges).collect()
    assert len(found) == len({r.id for r in found})
    assert {r.id: r.component for r in found} == expected_components(GRAPHS[name])


def test_no_cross_join(spark):
    plan = identity.match_edges(frame(spark, random_rows(5, 50)))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan

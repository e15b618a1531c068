"""Plain-Python versions of what the operators compute, for small inputs."""

import collections
import hashlib
import re

WORD = re.compile("[^\x20\x09-\x0D]+")


def frame(spark, rows, ddl, parts=3):
    return spark.createDataFrame(rows, ddl).repartition(parts)


def written(spark, tmp_path, name, df):
    df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def joined(spans):
    return ",".join("%s:%d:%d" % s for s in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def near_classes(texts, n=5, num=4, den=5):
    """Links per text and smallest index of each text's class, by comparing all pairs that share an n-gram."""
    sets = []
    for t in texts:
        w = WORD.findall(t or "")
        k = min(n, len(w))
        sets.append({tuple(w[i: i + k]) for i in range(len(w) - k + 1)} if w else set())
    where = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s or [()]:
            where[g].append(i)
    links, parent = [0] * len(sets), list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        shared = collections.Counter(j for g in s or [()] for j in where[g])
        for j, c in shared.items():
            if j != i and (not s or den * c >= num * (len(s) + len(sets[j]) - c)):
                links[i] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return links, [find(i) for i in range(len(sets))]


def removed_repeats(texts, length):
    """(bytes, removed, spans, digest of the rest) of each text, by counting all windows."""
    raws = [(t or "").encode() for t in texts]
    seen = collections.Counter(r[i: i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i: i + length]] > 1:
                gone[i: i + length] = b"\1" * length
        spans = sum(1 for i in range(len(r)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(r), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(r, gone, strict=True) if not g)).hexdigest()))
    return out

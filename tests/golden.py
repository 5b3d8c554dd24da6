"""Small hand-made inputs."""

from namepulse.schemas import RECORD_COLUMNS


def record_line(key, date, names, extras=""):
    fields = {
        "GKGRECORDID": key,
        "DATE": date,
        "SourceCollectionIdentifier": "1",
        "AllNames": names,
        "Extras": extras,
    }
    return "\t".join(fields.get(c, "") for c in RECORD_COLUMNS)


RECORDS = [
    record_line(
        "20150218230000-0", "20150218230000", "Alice Ames,10;Bob Bell,40;Alice Ames,77"
    ),
    record_line(
        "20150218230000-1",
        "20150218230000",
        "Bob Bell,5;ParentCategory News,9;SubCategory Art,12;Cara Cole,30",
    ),
    record_line("20150219000000-0", "20150219000000", "Cara Cole,3;;Dan-Dee Doe,8;"),
    record_line("20150219000000-1", "20150219000000", "", "x"),
    record_line("20150219000000-2", "20150219000000", ""),
    record_line("20150220000000-0", "20150220000000", "SubCategory Art,1"),
]

# (name, second) in arrival order, and every change of the rolling count.
ROLLING_INPUT = [("a", 0), ("a", 0), ("b", 1800), ("b", 4200), ("c", 7140)]
ROLLING_CHANGES = [
    (0, "a", 1, "add"),
    (0, "a", 2, "add"),
    (1800, "b", 1, "add"),
    (3600, "a", 0, "expire"),
    (4200, "b", 2, "add"),
    (5400, "b", 1, "expire"),
    (7140, "c", 1, "add"),
    (7800, "b", 0, "expire"),
    (10740, "c", 0, "expire"),
]


def brute_force_changes(mentions, window=3600):
    """Changes of (name, sec) mentions, second by second."""
    out = []
    names = {n for n, _ in mentions}
    for name in names:
        secs = sorted(s for n, s in mentions if n == name)
        for at in sorted(set(secs) | {s + window for s in secs}):
            live = sum(1 for s in secs if at - window < s < at)
            if at - window in secs:
                out.append((at, name, live, "expire"))
            for i in range(secs.count(at)):
                out.append((at, name, live + i + 1, "add"))
    return sorted(out)

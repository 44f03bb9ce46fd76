"""Plain-Python statements of what the ordered operators compute, for small fixtures."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict

VIEWING = ("0x03", "0x04", "0x05", "0x06")
HEART, INIT = "0x100", "0x01"


def below(times, t):
    at = bisect_left(times, t)
    return times[at - 1] if at else None


def above(times, t):
    at = bisect_right(times, t)
    return times[at] if at < len(times) else None


def end_of(start, limit, plays, hearts, inits):
    """End of a start that has no stop."""
    def late(t):
        return t is not None and t > start

    end = above(plays, start)
    if end is None:
        if not hearts or hearts[-1] <= start:
            return start + 300
        end = hearts[-1]
    boot = below(inits, end)
    if late(boot):
        heard = below(hearts, boot)
        if not late(heard):
            return start + 300
        second = below(inits, heard)
        if late(second):
            earlier = below(hearts, second)
            if late(earlier):
                return earlier
        return heard
    heard = below(hearts, end)
    if late(heard):
        return end if end - heard <= 1200 else heard
    return start + 300 if end - start > limit else end


def sessions(rows):
    """rows: (user, state, ts, play, rid).  Yields (user, state, start, end, rid)."""
    users = defaultdict(list)
    for row in rows:
        users[row[0]].append(row)
    out = []
    for user, mine in users.items():
        plays = sorted({r[2] for r in mine if r[3]})
        hearts = sorted({r[2] for r in mine if r[1] == HEART})
        inits = sorted({r[2] for r in mine if r[1] == INIT})
        for state in VIEWING:
            limit = 14400 if state in ("0x04", "0x05") else 28800
            open_row = None
            for row in sorted((r for r in mine if r[1] == state), key=lambda r: (r[2], r[3], r[4])):
                if open_row is not None:
                    end = end_of(open_row[2], limit, plays, hearts, inits) if row[3] else row[2]
                    out.append((user, state, open_row[2], end, open_row[4]))
                open_row = row if row[3] else None
            if open_row is not None:
                end = end_of(open_row[2], limit, plays, hearts, inits)
                out.append((user, state, open_row[2], end, open_row[4]))
    return sorted(out)


def trigrams(rows, boot):
    """rows: (user, kind 'page'|'on', ts, rid, name)."""
    users = defaultdict(list)
    for row in rows:
        users[row[0]].append(row)
    out = []
    for user, mine in users.items():
        pages = sorted((r[2], r[3], r[4]) for r in mine if r[1] == "page" and r[4])
        if not pages:
            continue
        names = [p[2] for p in pages]
        ons = [r[2] for r in mine if r[1] == "on"]
        booted = bool(ons) and min(ons) < pages[0][0]
        if booted:
            names.insert(0, boot)
        padded = ["", "", *names, "", ""]
        for i in range(len(names) + 2):
            if (booted and i == 0) or (len(names) == 1 and i == 1):
                continue
            out.append((user, *padded[i:i + 3]))
    return sorted(out)


def last_pages(rows):
    """rows: (user, state, ts, rid, name, status).  Page name per accepted order."""
    out = []
    for user in {r[0] for r in rows}:
        seen = ""
        mine = [r for r in rows if r[0] == user]
        for r in sorted(mine, key=lambda r: (r[2], r[1] != "0x07", r[3])):
            if r[1] == "0x07":
                seen = r[4]
            elif r[5] == "1":
                out.append((user, r[3], seen))
    return sorted(out)

"""Seeded game documents, and a plain-Python account of what they must become."""

from __future__ import annotations

import json
import random

CODES = ["FF", "SI", "SL", "CH", "CU", "FC", "XX", None]


def event(rng, end, number, **changes):
    strike = rng.random() < 0.4
    ball = not strike and rng.random() < 0.6
    code = rng.choice(CODES)
    out = {
        "type": "pitch", "pitchNumber": number, "endTime": end,
        "count": {"balls": rng.randint(0, 4), "strikes": rng.randint(0, 3), "outs": rng.randint(0, 2)},
        "details": {"code": "C" if strike else "B" if ball else "X", "isStrike": strike, "isBall": ball,
                    "isInPlay": not strike and not ball,
                    "type": {"code": code, "description": code and f"kind {code}"}, "call": {"description": "call"}},
        "pitchData": {"typeConfidence": round(rng.random(), 3)},
    }
    out.update(changes)
    return out


def game(pk, seed=0, at_bats=12, clean=False):
    """A clean game has every attribute set and every at-bat end matched."""
    rng = random.Random(seed * 1000 + pk)
    plays, clock = [], 0
    for i in range(at_bats):
        n = rng.randint(1, 5) if clean else rng.randint(0, 5)
        events = []
        for k in range(n):
            clock += 1
            events.append(event(rng, f"t{clock:04d}", k + 1))
        end = f"t{clock:04d}" if events else f"empty{i}"
        play = {
            "atBatIndex": i, "playEndTime": end, "result": {"event": rng.choice(["Single", "Walk"])},
            "about": {"halfInning": "top" if i % 6 < 3 else "bottom"},
            "count": {"balls": rng.randint(0, 4), "strikes": rng.randint(0, 3), "outs": rng.randint(0, 3)},
            "matchup": {"batter": {"id": 100 + i % 5, "fullName": f"Batter {i % 5}"},
                        "pitcher": {"id": 200 + i // 6, "fullName": f"Pitcher {i // 6}"},
                        "splits": {"menOnBase": rng.choice(["Empty", "RISP"])}},
            "pitchIndex": list(range(n)), "playEvents": events,
        }
        if not clean:
            if i == 1:
                play["playEndTime"] = "nothing ends here"
            if i == 3:
                play["result"]["event"] = None
            if i == 4:
                play["about"]["halfInning"] = None
            if i == 6 and events:  # not a pitch, no number
                events[0] = {**events[0], "type": "action", "pitchNumber": None}
            if i == 8:  # the end of the at-bat before
                play["playEndTime"] = plays[-1]["playEndTime"]
            if i == 9:
                play["playEndTime"] = None
                if events:
                    events[0]["endTime"] = None
        plays.append(play)
    if not clean:  # events after the last at-bat end
        plays[-1]["playEvents"] += [event(rng, f"late{k}", k + 9) for k in range(2)]
    team = lambda name, league: {"name": name, "sport": {"id": 1, "name": "Major"}, "league": {"id": league, "name": f"L{league}"}}
    return {
        "game_pk": pk,
        "gameData": {"datetime": {"dateTime": f"2020-08-{1 + pk % 28:02d}T23:05:00Z"}, "status": {"abstractGameState": "Final"},
                     "teams": {"home": team(f"H{pk}", 103), "away": team(f"A{pk}", 104)}},
        "liveData": {"plays": {"allPlays": plays, "currentPlay": {"atBatIndex": at_bats - 1}}},
    }


AT_BAT_FIELDS = ["atBatIndex", "result.event", "about.halfInning", "count.balls.end", "count.strikes.end", "count.outs.end",
                 "matchup.batter.id", "matchup.batter.fullName", "matchup.pitcher.id", "matchup.pitcher.fullName",
                 "matchup.splits.menOnBase"]


def _at_bat(p):
    return {"atBatIndex": p["atBatIndex"], "result.event": p["result"]["event"], "about.halfInning": p["about"]["halfInning"],
            "count.balls.end": p["count"]["balls"], "count.strikes.end": p["count"]["strikes"],
            "count.outs.end": p["count"]["outs"], "matchup.batter.id": p["matchup"]["batter"]["id"],
            "matchup.batter.fullName": p["matchup"]["batter"]["fullName"], "matchup.pitcher.id": p["matchup"]["pitcher"]["id"],
            "matchup.pitcher.fullName": p["matchup"]["pitcher"]["fullName"],
            "matchup.splits.menOnBase": p["matchup"]["splits"]["menOnBase"]}


def expected(doc, attach="reference"):
    """Rows of one game by brute force, as dicts keyed by output name (a selection of columns)."""
    plays = doc["liveData"]["plays"]["allPlays"]
    rows, pos = [], 0
    for parent in plays:
        for e in parent["playEvents"]:
            found = [p for p in plays if p["playEndTime"] == e["endTime"]] if attach == "reference" else [parent]
            for p in found or [None]:
                row = dict.fromkeys(AT_BAT_FIELDS) if p is None else _at_bat(p)
                rows.append({"event_pos": pos, "endTime": e["endTime"], "pitchNumber": e["pitchNumber"],
                             "count.strikes.start": e["count"]["strikes"], **row})
            pos += 1
    if attach == "reference":
        for name in AT_BAT_FIELDS:
            below = None
            for row in reversed(rows):
                below = row[name] if row[name] is not None else below
                row[name] = below
    home, away = (doc["gameData"]["teams"][s]["name"] for s in ("home", "away"))
    for row in rows:
        half, mates = row["about.halfInning"], [r["pitchNumber"] for r in rows if r["atBatIndex"] == row["atBatIndex"]]
        row["batting_team"] = None if half is None else home if half == "bottom" else away
        row["fielding_team"] = None if half is None else away if half == "bottom" else home
        row["last.pitch.of.ab"] = None if None in mates else "true" if row["pitchNumber"] == max(mates) else "false"
        row["game_pk"], row["game_date"] = doc["game_pk"], doc["gameData"]["datetime"]["dateTime"][:10]
    return rows


def lines(docs):
    return [json.dumps(d) for d in docs]

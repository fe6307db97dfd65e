"""Declarative contracts of the payload documents.

A contract is a nested dictionary of field names.  ``name!`` is required,
``name!?`` required but nullable, a bare name optional; ``name=other`` is read
as name and called other from then on.  A value is a type name
(str, int, float, bool, map, raw), a dictionary (an object), a one-element list
(an array) or a tuple of type and default; the default stands for an absent
key only, an explicit null there is an error.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

SPORT = {"name!": "str", "slug!": "str", "id!": "int"}
CATEGORY = {"name!": "str", "id!": "int", "slug!": "str", "sport!": SPORT}
TOURNAMENT = {"id!": "int", "name!": "str", "slug!": "str", "category!": CATEGORY}
COUNTRY = {"name": "str", "slug": "str", "alpha2": "str", "alpha3": "str"}
COLOURS = {"primary!": "str", "secondary!": "str", "text!": "str"}
TEAM = {"name!": "str", "slug!": "str", "shortName": "str", "nameCode!": "str", "gender!": "str", "sport!": SPORT, "country!?": COUNTRY, "teamColors!": COLOURS}
SCORE = {k: "int" for k in ("current", "display", "period1", "period2", "normaltime")}
STATUS = {"code!": "int", "description!": "str", "type!": "str"}
TIME = {"injuryTime1": ("int", 0), "injuryTime2": ("int", 0), "currentPeriodStartTimestamp": "int"}
SEASON = {"name!": "str", "id!": "int", "year!": "str"}
FLAGS = {k: ("bool", False) for k in ("hasGlobalHighlights", "hasXg", "hasEventPlayerStatistics", "hasEventPlayerHeatMap")}
EVENT = {
    "slug!": "str", "id!": "int", "startTimestamp": "int", "status!": STATUS, "time": TIME, "tournament": TOURNAMENT, "season": SEASON, "roundInfo": {"round": "int"},
    "winnerCode": "int", "homeScore": SCORE, "awayScore": SCORE, "homeTeam!": TEAM, "awayTeam!": TEAM, **FLAGS,
}
COORDINATES = {"latitude!": "float", "longitude!": "float"}
VENUE = {"name!": "str", "slug!": "str", "capacity": "int", "id!": "int", "city!": {"name!": "str"}, "venueCoordinates": COORDINATES, "country": COUNTRY, "stadium": {"name!": "str", "capacity": "int"}}
MANAGER = {"name!": "str", "slug!": "str", "shortName!": "str", "id!": "int", "country": COUNTRY}
REFEREE = {"name!": "str", "slug!": "str", "id!": "int", "yellowCards!": "int", "redCards!": "int", "yellowRedCards!": "int", "games!": "int", "sport!": SPORT, "country": COUNTRY}
FOOTBALL_TEAM = {**TEAM, "fullName": "str", "manager": MANAGER, "venue": VENUE, "class=class_": "int"}
BASE_EVENT = {
    **{k: v for k, v in EVENT.items() if k not in ("tournament", "homeTeam!", "awayTeam!")}, "tournament!": {**TOURNAMENT, "competitionType": "int"},
    "homeTeam!": FOOTBALL_TEAM, "awayTeam!": FOOTBALL_TEAM, "attendance": "int", "venue": VENUE, "referee": REFEREE, "defaultPeriodCount": "int", "defaultPeriodLength": "int",
    "defaultOvertimeLength": "int", "currentPeriodStartTimestamp": "int", "fanRatingEvent": "bool", "seasonStatisticsType": "str", "showTotoPromo": "bool",
}
STAT_ITEM = {
    "key!": "str", "name!": "str", "home!": "str", "away!": "str", "compareCode!": "int", "statisticsType!": "str", "valueType!": "str",
    "homeValue!": "float", "awayValue!": "float", "renderType!": "int", "homeTotal": "int", "awayTotal": "int",
}
PLAYER = {
    "name!": "str", "id!": "int", "firstName": "str", "lastName": "str", "slug": "str", "shortName": "str", "position": "str", "jerseyNumber": "str", "height": "int",
    "userCount": "int", "country": COUNTRY, "marketValueCurrency": "str", "dateOfBirthTimestamp": "int", "proposedMarketValueRaw": {"value": "int", "currency": "str"},
}
# The per-player statistics of the line-ups document.
PLAYER_FLOATS = ("rating", "expectedGoals", "expectedAssists", "goalsPrevented")
PLAYER_INTS = (
    "minutesPlayed", "touches", "goals", "goalAssist", "totalPass", "accuratePass", "totalLongBalls", "accurateLongBalls", "totalCross", "accurateCross", "keyPass", "duelWon", "duelLost",
    "aerialWon", "aerialLost", "totalContest", "wonContest", "challengeLost", "dispossessed", "possessionLostCtrl", "fouls", "wasFouled", "totalTackle", "interceptionWon", "totalClearance",
    "outfielderBlock", "onTargetScoringAttempt", "blockedScoringAttempt", "shotOffTarget", "bigChanceCreated", "bigChanceMissed", "totalOffside", "saves", "punches", "goodHighClaim",
    "savedShotsFromInsideTheBox", "totalKeeperSweeper", "accurateKeeperSweeper", "errorLeadToAShot",
)
PLAYER_STATS = {**{k: "int" for k in PLAYER_INTS}, **{k: "float" for k in PLAYER_FLOATS}, "ratingVersions": "map"}
LINEUP_PLAYER = {"player!": PLAYER, "teamId!": "int", "shirtNumber": "int", "jerseyNumber": "str", "position": "str", "substitute": "bool", "captain": "bool", "statistics": PLAYER_STATS}
KIT = {"primary": "str", "number": "str", "outline": "str", "fancyNumber": "str"}
MISSING = {"player!": PLAYER, "type": "str", "reason": "int"}
SIDE = {"players!": [LINEUP_PLAYER], "supportStaff": (["raw"], []), "formation": "str", "playerColor": KIT, "goalkeeperColor": KIT, "missingPlayers": ([MISSING], [])}
POINT = {"x!": "float", "y!": "float"}
NETWORK_ACTION = {
    "player!": PLAYER, "eventType!": "str", "time!": "int", "playerCoordinates!": POINT, "passEndCoordinates": POINT, "gkCoordinates": POINT, "goalShotCoordinates": POINT, "goalMouthCoordinates": POINT,
    "goalkeeper": PLAYER, "isHome!": "bool", "isAssist": "bool", "bodyPart": "str", "goalType": "str",
}
INCIDENT = {
    "incidentType!": "str", "id": "int", "time": "int", "addedTime": "int", "text": "str", "homeScore": "int", "awayScore": "int", "isLive": "bool", "timeSeconds": "int", "reversedPeriodTime": "int",
    "reversedPeriodTimeSeconds": "int", "periodTimeSeconds": "int", "length": "int", "injury": "bool", "isHome": "bool", "incidentClass": "str", "playerIn": PLAYER, "playerOut": PLAYER,
    "player": PLAYER, "playerName": "str", "reason": "str", "rescinded": "bool", "confirmed": "bool", "decision": "str", "assist1": PLAYER, "assist2": PLAYER, "footballPassingNetworkAction": [NETWORK_ACTION],
}
# Required fields of each incident type; those in NULLABLE may hold a null.
INCIDENT_REQUIRED = {
    "period": ("text", "homeScore", "awayScore", "isLive", "time", "addedTime", "timeSeconds", "reversedPeriodTime", "reversedPeriodTimeSeconds", "periodTimeSeconds"),
    "injuryTime": ("length", "time", "addedTime", "reversedPeriodTime"),
    "substitution": ("id", "time", "injury", "isHome", "incidentClass", "reversedPeriodTime"),
    "card": (),
    "inGamePenalty": (),
    "varDecision": (),
    "goal": ("id", "time", "isHome", "incidentClass", "reversedPeriodTime"),
}
INCIDENT_NULLABLE = {"period": ("homeScore", "awayScore")}
COLOUR_SIDE = {"goalkeeperColor!": KIT, "playerColor!": KIT}
CHOICE = {"initialFractionalValue!": "fraction", "fractionalValue!": "fraction", "sourceId": "int", "name!": "str", "winning": "bool", "change!": "int"}
MARKET = {"marketId!": "int", "marketName!": "str", "marketGroup!": "str", "isLive!": "bool", "suspended!": "bool", "choiceGroup": "str", "choices!": [CHOICE]}


@dataclass(frozen=True)
class Contract:
    """A document kind: its fields and where its elements with defaults sit."""

    name: str
    fields: dict[str, Any]
    #: (path of an object or array of objects, names of fields whose explicit null is an error)
    no_nulls: tuple[tuple[str, tuple[str, ...]], ...] = ()


_flags = tuple(FLAGS)
CONTRACTS = {
    c.name: c
    for c in (
        Contract("tournament", {"tournament!": TOURNAMENT}),
        Contract("seasons", {"seasons!": [SEASON]}),
        Contract("events", {"events!": [EVENT]}, (("events[]", _flags), ("events[].time", ("injuryTime1", "injuryTime2")))),
        Contract("base", {"event!": BASE_EVENT}, (("event", _flags), ("event.time", ("injuryTime1", "injuryTime2")))),
        Contract("stats", {"statistics!": [{"period!": "str", "groups!": [{"groupName!": "str", "statisticsItems!": [STAT_ITEM]}]}]}),
        Contract("lineups", {"confirmed": "bool", "home": SIDE, "away": SIDE}, tuple((s, ("supportStaff", "missingPlayers")) for s in ("home", "away"))),
        Contract("incidents", {"incidents!": [INCIDENT], "home!": COLOUR_SIDE, "away!": COLOUR_SIDE}),
        Contract("graph", {"graphPoints": [{"minute!": "float", "value!": "int"}], "periodTime!": "int", "overtimeLength!": "int", "periodCount!": "int"}),
        Contract("odds", {"markets!": [MARKET], "eventId!": "int"}),
    )
}

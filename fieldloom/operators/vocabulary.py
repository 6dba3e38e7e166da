"""Fixed values of the event format."""

# Source event types and their canonical names.
EVENT_TYPES = {
    "50/50": "fifty_fifty",
    "Bad Behaviour": "bad_behaviour",
    "Ball Receipt*": "ball_receipt",
    "Ball Recovery": "ball_recovery",
    "Block": "block",
    "Carry": "carry",
    "Clearance": "clearance",
    "Dispossessed": "dispossessed",
    "Dribble": "dribble",
    "Dribbled Past": "dribbled_past",
    "Duel": "duel",
    "Error": "error",
    "Foul Committed": "foul_committed",
    "Foul Won": "foul_won",
    "Goal Keeper": "goalkeeper",
    "Half End": "half_end",
    "Half Start": "half_start",
    "Injury Stoppage": "injury_stoppage",
    "Interception": "interception",
    "Miscontrol": "miscontrol",
    "Offside": "offside",
    "Own Goal Against": "own_goal_against",
    "Own Goal For": "own_goal_for",
    "Pass": "pass",
    "Player Off": "player_off",
    "Player On": "player_on",
    "Pressure": "pressure",
    "Referee Ball-Drop": "referee_ball_drop",
    "Shield": "shield",
    "Shot": "shot",
    "Starting XI": "starting_xi",
    "Substitution": "substitution",
    "Tactical Shift": "tactical_shift",
}
# Types whose detail object stands under their own name; one has another name.
DETAIL_TYPES = ("fifty_fifty", "ball_receipt", "ball_recovery", "block", "carry", "clearance", "dribble", "duel", "foul_committed", "foul_won", "goalkeeper", "injury_stoppage", "interception", "pass", "player_off", "shot", "substitution")
DETAIL_KEYS = {t: "50_50" if t == "fifty_fifty" else t for t in DETAIL_TYPES}
# Types by what they may or must have.
ENDPOINT_TYPES = ("pass", "carry", "shot", "goalkeeper")
ENDPOINT_REQUIRED = ("pass", "carry", "shot")
OUTCOME_TYPES = ("fifty_fifty", "ball_receipt", "dribble", "duel", "goalkeeper", "interception", "pass", "shot", "substitution")
OUTCOME_OPTIONAL = ("duel", "goalkeeper")
OUTCOME_IMPLICIT = ("ball_receipt", "pass")
PLAYER_OPTIONAL = ("half_end", "half_start", "own_goal_for", "referee_ball_drop", "starting_xi", "tactical_shift")
LOCATION_OPTIONAL = ("bad_behaviour", "half_end", "half_start", "injury_stoppage", "player_off", "player_on", "starting_xi", "substitution", "tactical_shift")
ACTIONABLE = ("pass", "dribble", "carry", "foul_committed", "duel", "interception", "shot", "own_goal_against", "goalkeeper", "clearance", "miscontrol")
# Minute in which each period begins.
PERIOD_START = {1: 0, 2: 45, 3: 90, 4: 105, 5: 120}
# Fixed value: the format's field for the chance of a shot.
CHANCE_FIELD = "statsbomb_xg"

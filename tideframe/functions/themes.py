"""Theme of a text by an ordered chain of substring rules, compiled to one CASE expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

Rule = tuple[Sequence[str], str]
OTHER = "other gaming"

#: Needles and theme, in the order in which they are tried. The first that is contained wins.
RULES: list[Rule] = [
    (("roblox",), "roblox"),
    (("minecraft",), "minecraft"),
    (("cs2", "counter-strike", "counter strike"), "counter-strike 2"),
    (("valorant",), "valorant"),
    (("fortnite",), "fortnite"),
    (("gta", "grand theft auto"), "gta"),
    (("league of legends",), "league of legends"),
    (("dota",), "dota 2"),
    (("apex",), "apex legends"),
    (("overwatch",), "overwatch 2"),
    (("call of duty", "warzone", "cod"), "call of duty"),
    (("pubg",), "pubg"),
    (("free fire",), "free fire"),
    (("brawl stars",), "brawl stars"),
    (("clash royale",), "clash royale"),
    (("clash of clans",), "clash of clans"),
    (("genshin",), "genshin impact"),
    (("fifa", "fc 25", "ea sports fc"), "sports / fifa"),
    (("nba 2k",), "sports / nba 2k"),
    (("rocket league",), "rocket league"),
    (("rainbow six", "r6"), "rainbow six siege"),
    (("elden ring",), "elden ring"),
    (("dark souls",), "dark souls"),
    (("wukong", "black myth"), "black myth wukong"),
    (("cyberpunk",), "cyberpunk 2077"),
    (("red dead", "rdr2"), "red dead redemption 2"),
    (("skyrim", "elder scrolls"), "skyrim"),
    (("resident evil",), "resident evil"),
    (("fnaf", "five nights"), "five nights at freddys"),
    (("phasmophobia",), "phasmophobia"),
    (("lethal company",), "lethal company"),
    (("among us",), "among us"),
    (("helldivers",), "helldivers 2"),
    (("monster hunter",), "monster hunter wilds"),
    (("mario kart",), "mario kart"),
    (("zelda",), "zelda"),
    (("pokemon",), "pokemon"),
    (("esports", "e-sports", "competitive", "pro gamer"), "esports"),
    (("survival",), "survival"),
    (("horror", "scp"), "horror"),
    (("battle royale",), "battle royale"),
    (("rpg", "roleplay", "role-play"), "rpg"),
    (("strategy", "tactic"), "strategy game"),
    (("simulator", "simulation"), "simulator game"),
    (("indie",), "indie game"),
    (("open world", "sandbox"), "open world / sandbox"),
    (("anime",), "anime games"),
    (("retro",), "retro gaming"),
    (("mobile",), "mobile gaming"),
    (("vr", "virtual reality"), "vr gaming"),
    (("walkthrough", "playthrough", "no commentary"), "walkthrough / playthrough"),
    (("speedrun",), "speedrun"),
    (("boss fight",), "boss fight"),
    (("tutorial", "tips", "tricks", "guide", "settings"), "tutorial / guides"),
    (("highlight", "montage", "clip", "short", "top plays", "clutch", "trickshot"), "highlights & clips"),
    (("funny", "meme", "fail", "rage", "reaction"), "funny moments & memes"),
    (("stream", "twitch", "livestream"), "livestream / vod"),
    (("review", "news"), "gaming news & reviews"),
    (("challenge",), "gaming challenges"),
    (("co-op", "multiplayer"), "multiplayer / co-op"),
    (("setup", "keyboard", "mouse", "hardware", "aim training"), "hardware & setup"),
    (("ai gaming", "unreal engine"), "tech & ai gaming"),
    (("fps", "firstperson", "first-person", "shooter"), "fps"),
]
#: Texts that are a theme only if they are nothing else.
WHOLE = {"league of legends": ("lol",)}
#: What is cut from both ends of a text: the space and all control characters before it.
_BLANK = "".join(map(chr, range(33)))


def theme(text: Column, rules: Sequence[Rule] = RULES, whole: dict[str, Sequence[str]] = WHOLE, default: str = OTHER) -> Column:
    """The theme of the first rule of which a needle stands in the lower-cased text; the default for none or null. Spaces
    and control characters at both ends don't count."""
    low = F.lower(F.btrim(text, F.lit(_BLANK)))
    out = F
    for needles, name in rules:
        hit = F.lit(False)
        for needle in needles:
            hit = hit | low.contains(needle)
        for equal in whole.get(name, ()):
            hit = hit | (low == equal)
        out = out.when(hit, name)
    return out.otherwise(default)


def theme_sql(text: str, rules: Sequence[Rule] = RULES, whole: dict[str, Sequence[str]] = WHOLE, default: str = OTHER) -> str:
    """The same rules as SQL."""
    low = rf"lower(regexp_replace({text}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g'))"
    cases = []
    for needles, name in rules:
        hits = [f"contains({low}, '{n}')" for n in needles] + [f"{low} = '{e}'" for e in whole.get(name, ())]
        cases.append(f"WHEN {' OR '.join(hits)} THEN '{name}'")
    return f"CASE {' '.join(cases)} ELSE '{default}' END"

"""Vocabularies that results depend on."""

from __future__ import annotations

#: Abbreviations of column names and the names they stand for.
ABBREVIATIONS = {
    "atk": ("attack",), "def": ("defense", "defence"), "hp": ("hitpoint", "health", "healthpoint"), "mp": ("mana", "manapoint", "magic"),
    "sp": ("skill_point", "stamina", "special"), "spd": ("speed",), "crit": ("critical",), "dmg": ("damage",), "str": ("strength",),
    "agi": ("agility",), "int": ("intelligence",), "vit": ("vitality",), "luk": ("luck",), "exp": ("experience",), "lv": ("level",),
    "lvl": ("level",), "char": ("character",), "npc": ("non_player_character",), "mob": ("monster",), "equip": ("equipment",), "wpn": ("weapon",),
    "itm": ("item",), "inv": ("inventory",), "ach": ("achievement",), "evt": ("event",), "tsk": ("task",), "qst": ("quest",), "dng": ("dungeon",),
    "pvp": ("player_vs_player",), "pve": ("player_vs_environment",), "cfg": ("config", "configuration"), "desc": ("description",), "txt": ("text",),
    "img": ("image",), "btn": ("button",), "ui": ("user_interface",), "bgm": ("background_music",), "sfx": ("sound_effect",),
    "vfx": ("visual_effect",), "res": ("resource",), "sid": ("skill",), "tid": ("task", "template"), "gid": ("group",), "pid": ("player",),
    "mid": ("monster", "map"), "eid": ("event", "equipment"), "rid": ("reward", "role"), "cid": ("character", "chapter"),
    "aid": ("activity", "achievement"), "bid": ("buff", "battle"), "did": ("dungeon",), "wid": ("weapon", "world"), "cd": ("cooldown",),
    "buff": ("buff",), "debuff": ("debuff",), "aoe": ("area_of_effect",), "dot": ("damage_over_time",), "hot": ("heal_over_time",),
    "cc": ("crowd_control",), "rng": ("random_number_generator", "range"), "prob": ("probability",), "pct": ("percent", "percentage"),
    "cnt": ("count",), "num": ("number",), "max": ("maximum",), "min": ("minimum",), "dur": ("duration",), "req": ("requirement", "require"),
    "cond": ("condition",), "tgt": ("target",), "src": ("source",), "dst": ("destination",), "prev": ("previous",), "nxt": ("next",),
    "cur": ("current",), "tmp": ("temporary",), "perm": ("permanent",),
}

#: Domains of table names; the first one of which a word occurs in the name holds.
DOMAIN_RULES = {
    "hero": ("hero", "character", "char_"), "skill": ("skill", "ability", "spell", "buff", "talent"),
    "battle": ("battle", "fight", "pvp", "war", "combat", "army"), "item": ("item", "equip", "prop", "goods", "material", "resource"),
    "building": ("building", "construct", "castle", "city"), "quest": ("quest", "task", "mission", "chapter", "stage"),
    "alliance": ("alliance", "guild", "union", "clan", "legion"), "monster": ("monster", "enemy", "npc", "mob", "boss", "creature"),
    "reward": ("reward", "drop", "loot", "prize", "chest", "gift"), "world": ("map", "world", "terrain", "region", "area", "field"),
    "social": ("mail", "chat", "message", "notice", "friend"), "config": ("config", "setting", "param", "const", "global", "system"),
}

#: Words of each domain; the longest one that occurs in a name decides.
DOMAIN_WORDS = {
    "hero": ("hero", "character", "role", "char", "player"), "skill": ("skill", "ability", "talent", "spell", "magic"),
    "item": ("item", "goods", "product", "material", "equip", "equipment", "weapon", "armor"),
    "monster": ("monster", "enemy", "mob", "boss", "creature", "npc"), "quest": ("quest", "task", "mission", "story", "chapter", "campaign"),
    "dungeon": ("dungeon", "stage", "level", "map", "scene", "instance"), "reward": ("reward", "prize", "loot", "drop", "bonus", "gift"),
    "shop": ("shop", "store", "mall", "trade", "exchange"), "activity": ("activity", "event", "festival", "season", "campaign"),
    "ui": ("ui", "interface", "menu", "dialog", "text", "localization", "i18n", "lang"),
    "battle": ("battle", "combat", "fight", "arena", "pvp", "pve", "war"), "social": ("guild", "clan", "team", "friend", "chat", "mail", "social"),
    "gacha": ("gacha", "summon", "draw", "pool", "banner", "wish", "lottery"),
    "growth": ("upgrade", "enhance", "evolve", "awaken", "refine", "breakthrough", "star"),
}

#: Chinese names of entities and the table names they may stand for.
ENTITIES = {
    "技能": ("skill", "ability", "talent", "spell"), "英雄": ("hero", "character", "champion", "role"), "物品": ("item", "goods", "product"),
    "道具": ("item", "prop"), "装备": ("equip", "equipment", "gear"), "活动": ("activity", "event"), "怪物": ("monster", "enemy", "mob", "creature"),
    "建筑": ("building", "construct"), "兵种": ("army", "troop", "soldier", "unit"), "科技": ("science", "tech", "technology", "research"),
    "武器": ("weapon", "arm"), "任务": ("quest", "task", "mission"), "关卡": ("stage", "instance", "dungeon", "level"), "奖励": ("reward", "prize", "bonus"),
    "商店": ("shop", "store", "mall"), "公会": ("guild", "alliance", "clan"), "联盟": ("alliance", "league", "union"), "地图": ("map", "world", "scene"),
    "角色": ("hero", "character", "role", "avatar"), "宝箱": ("chest", "box", "treasure"), "资源": ("resource", "res"), "阵营": ("camp", "faction", "side"),
    "特效": ("effect", "vfx"), "buff": ("buff",), "天赋": ("talent", "perk"), "皮肤": ("skin", "costume"), "称号": ("title",), "成就": ("achievement",),
    "副本": ("instance", "dungeon", "raid"), "战斗": ("battle", "combat", "fight"), "赛季": ("season",), "排行": ("rank", "leaderboard"),
    "邮件": ("mail", "message"), "聊天": ("chat",), "vip": ("vip",), "等级": ("level", "grade"), "星级": ("star",), "品质": ("quality", "rarity"),
    "卡牌": ("card",), "宠物": ("pet", "familiar"), "坐骑": ("mount", "ride"), "背包": ("bag", "inventory", "backpack"), "签到": ("signin", "checkin"),
    "抽卡": ("gacha", "draw", "summon"), "好友": ("friend", "social"), "战队": ("team", "squad", "party"), "法术": ("spell", "magic"),
    "伙伴": ("partner", "companion"), "神器": ("artifact", "relic"), "符文": ("rune",), "职业": ("class", "profession", "job", "vocation"),
    "种族": ("race", "tribe", "faction"), "图鉴": ("collection", "codex", "handbook"), "剧情": ("story", "plot", "scenario"), "阵型": ("formation",),
    "时装": ("fashion", "costume", "outfit"), "礼包": ("package", "bundle", "gift"), "通关": ("clear", "pass"), "竞技": ("arena", "pvp", "tournament"),
}

#: Chinese names of domains.
DOMAIN_NAMES = {
    "hero": ("英雄", "角色", "人物"), "skill": ("技能", "法术", "天赋"), "battle": ("战斗", "对战", "战争"), "item": ("物品", "道具", "装备", "材料"), "building": ("建筑", "城堡"),
    "quest": ("任务", "关卡", "副本"), "alliance": ("联盟", "公会"), "monster": ("怪物", "敌人", "Boss"), "reward": ("奖励", "掉落", "宝箱"), "world": ("地图", "世界", "场景"),
    "social": ("社交", "邮件", "聊天"), "config": ("配置", "系统", "参数"), "growth": ("成长", "升级", "进阶"), "gacha": ("抽卡", "召唤", "卡池"), "shop": ("商店", "商城"),
}

#: Parts of names of columns that are hardly keys.
NOISE_WORDS = (
    "name", "desc", "description", "title", "text", "content", "remark", "note", "comment", "icon", "image", "img", "path", "url", "file", "sound",
    "bgm", "sfx", "vfx", "prefab", "ui", "atlas", "bundle", "asset", "名字", "名称", "描述", "说明", "标题", "备注", "文本", "内容", "图标", "图片", "路径", "文件", "音效",
    "特效", "动画", "资源名",
)

#: Parts of names that suggest an identifier.
ID_WORDS = (
    "id", "key", "code", "index", "idx", "no", "ref", "type", "主键", "键值", "编号", "索引",
)

#: Endings of names of columns that hold several values.
COMPOUND_ENDINGS = (
    "_list", "_group", "_ids", "_items", "_rewards", "_costs", "_arr", "_array", "list", "group",
)

#: Column names that say nothing about a table.
GENERIC_NAMES = (
    "主键", "键值", "等级", "编号", "索引", "自增id", "序号", "排序", "优先级", "权重", "排序值", "显示顺序", "id", "key", "index", "idx", "no", "level", "lv", "order", "sort",
)

#: Endings of columns that refer to a table, in the order tried.
REFERENCE_ENDINGS = (
    "_id", "_key", "_no", "_code", "_idx", "_ref", "_type", "_group", "_list", "_num", "_index", "Id", "Key", "No", "Code", "Idx", "Ref", "Num",
    "Index", "_ID", "_KEY", "_NO", "_CODE", "_IDX", "_REF", "_NUM", "_INDEX",
)

#: Endings of columns with Chinese names that refer to a table, in the order tried.
CN_REFERENCE_ENDINGS = (
    "_id", "_key", "_no", "_code", "_idx", "_ref", "_type", "_group", "_list", "_num", "_index", "ID", "Id", "id", "编号", "编码", "序号", "索引",
)

#: Names of the column that is referred to where no key is known.
TARGET_NAMES = (
    "id", "ID", "Id", "key", "Key", "no", "code", "index",
)

#: Endings of names of primary keys.
KEY_ENDINGS = (
    "_id", "_key", "_no", "_code", "id", "key",
)

#: Names of primary keys.
KEY_NAMES = (
    "ID", "Id", "KEY", "Key", "code", "id", "index", "key", "no",
)

#: Words that a row of column types consists of.
TYPE_WORDS = (
    "array", "bool", "boolean", "byte", "color", "date", "datetime", "dict", "double", "enum", "float", "float[]", "int", "int16", "int32", "int64",
    "int8", "int[]", "json", "list", "long", "map", "number", "object", "short", "str", "string", "string[]", "text", "time", "uint", "uint16",
    "uint32", "uint64", "uint8", "vector2", "vector3",
)

#: Endings that the column index strips.
INDEX_ENDINGS = (
    "_id", "_key", "_code", "_no", "_idx", "_ref", "_type", "_num", "_index",
)

#: Endings of table names that their stem lacks.
STEM_ENDINGS = (
    "_base", "_config", "_data", "_info", "_list", "_detail", "_table", "_cfg", "_setting", "_param", "_define",
)

#: Endings stripped before a column name is looked up, and before it is taken for an abbreviation.
LOOKUP_ENDINGS = ("_id", "_key", "_no", "_code", "_type", "_idx")
CLEAN_ENDINGS = ("_id", "_code", "_key", "_no", "_num", "_idx", "_ref", "_type")

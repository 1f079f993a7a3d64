"""Stop words of the reports and of the classifiers."""

from __future__ import annotations

# Words left out of the word report.
REPORT_STOP_WORDS = [
    "будет", "будто", "было", "вообще", "всем", "всех", "даже", "если", "есть",
    "кажется", "какой", "когда", "которые", "лучше", "меня", "может", "можно",
    "надо", "ничего", "нужно", "около", "очень", "потом", "потому", "почему",
    "почти", "просто", "пусть", "сейчас", "сразу", "такие", "таких", "такой",
    "тебе", "тебя", "теперь", "тоже", "только", "хотя", "через", "чтобы",
    "этих", "этого", "этом",
]

# Words the forest drops on top of Spark's Russian list.
FOREST_EXTRA_WORDS = [
    "просто", "только", "вообще", "ну", "это", "как", "так", "в", "на", "и",
]

# Spark's default lists, equal to StopWordsRemover.loadDefaultStopWords.
# They stand here so that SQL can be built without a running JVM; a test compares them.
ENGLISH = """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom
    this that these those am is are was were be been being have has had having do does did
    doing a an the and but if or because as until while of at by for with about against
    between into through during before after above below to from up down in out on off over
    under again further then once here there when where why how all any both each few more
    most other some such no nor not only own same so than too very s t can will just don
    should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm
    you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't weren't
    haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
    couldn't cannot could here's how's let's ought that's there's what's when's where's who's
    why's would
""".split()
RUSSIAN = """
    и в во не что он на я с со как а то все она так его но да ты к у же вы за бы по только ее
    мне было вот от меня еще нет о из ему теперь когда даже ну вдруг ли если уже или ни быть
    был него до вас нибудь опять уж вам ведь там потом себя ничего ей может они тут где есть
    надо ней для мы тебя их чем была сам чтоб без будто чего раз тоже себе под будет ж тогда
    кто этот того потому этого какой совсем ним здесь этом один почти мой тем чтобы нее сейчас
    были куда зачем всех никогда можно при наконец два об другой хоть после над больше тот
    через эти нас про всего них какая много разве три эту моя впрочем хорошо свою этой перед
    иногда лучше чуть том нельзя такой им более всегда конечно всю между
""".split()


def spark_stop_words(language: str) -> list[str]:
    """Spark's own list."""
    return list({"english": ENGLISH, "russian": RUSSIAN}[language])


def forest_stop_words() -> list[str]:
    return spark_stop_words("russian") + FOREST_EXTRA_WORDS

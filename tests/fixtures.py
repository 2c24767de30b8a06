"""The tiny corpus with results worked out by hand."""

DOCS = [
    (1, "City &amp; time! Age of city\nThe city's age; time city."),
    (2, "Running runners ran. See http://x.y/z?a=b for the VIII. Time"),
    (3, "a b\n\n  \tCITY a city. É b"),
    (4, ""),
]
STOPWORD_LINES = ["the\r", "of \r", "\r", " A's \r", "for\r"]
TOP_WORDS = ["city", "time", "age", "a", "b", "viii", "zebra"]

SENTENCES = [
    (1, 0, 0, "City   time"), (1, 0, 1, "Age of city"), (1, 1, 0, "The city's age; time city"),
    (2, 0, 0, "Running runners ran"), (2, 0, 1, "See  for the VIII"), (2, 0, 2, "Time"),
    (3, 0, 0, "a b"), (3, 2, 0, "CITY a city"), (3, 2, 1, "É b"),
]
COUNTS = {"city": 6, "time": 3, "b": 2, "age": 2, "a": 2, "viii": 1, "see": 1, "s": 1,
          "running": 1, "runners": 1, "ran": 1}
# (distance, min_len) -> unordered pair -> count
PAIRS = {
    (1, 1): {"a,b": 1, "a,city": 2, "age,city": 2, "age,time": 1, "city,time": 2},
    (1, 2): {"age,city": 2, "age,time": 1, "city,city": 2, "city,time": 2},
    (2, 1): {"a,b": 1, "a,city": 2, "age,city": 3, "age,time": 1, "city,city": 2, "city,time": 3},
    (2, 2): {"age,city": 3, "age,time": 1, "city,city": 2, "city,time": 3},
}
STRIPES = {
    1: {"age": "{city=2, time=1}", "city": "{age=2, city=2, time=2}", "time": "{age=1, city=2}"},
    2: {"age": "{city=3, time=1}", "city": "{age=3, city=2, time=3}", "time": "{age=1, city=3}"},
}
DF = {"a": 2, "b": 2, "citi": 2, "time": 2, "ag": 1, "amp": 1, "http": 1, "ran": 1, "run": 1,
      "runner": 1, "s": 1, "see": 1, "viii": 1, "x": 1, "y": 1, "z": 1}
TF_IDF = [
    (1, "amp", 1, 1.609438), (1, "citi", 4, 4.394449), (1, "time", 2, 2.197225),
    (2, "http", 1, 1.609438), (2, "ran", 1, 1.609438), (2, "time", 1, 1.098612),
    (3, "citi", 2, 2.197225),
]
STEMS = dict(pair.split(">") for pair in """
caresses>caress ponies>poni ties>ti feed>feed agreed>agre plastered>plaster
motoring>motor sing>sing conflated>conflat hopping>hop falling>fall failing>fail
filing>file happy>happi sky>sky relational>relat conditional>condit
digitizer>digit triplicate>triplic hopeful>hope adjustment>adjust
adoption>adopt probate>probat rate>rate cease>ceas controll>control roll>roll
enjoy>enjoi use>us used>us this>thi category>categori university>univers
january>januari is>is bled>bled troubled>troubl sized>size hissing>hiss
fizzed>fizz tanned>tan valency>valenc hesitancy>hesit conformably>conform
radically>radic differently>differ vilely>vile analogously>analog
vietnamization>vietnam predication>predic operator>oper feudalism>feudal
decisiveness>decis hopefulness>hope callousness>callous formality>formal
sensitivity>sensit sensibility>sensibl formative>form formalize>formal
electricity>electr electrical>electr goodness>good revival>reviv
allowance>allow inference>infer airliner>airlin gyroscopic>gyroscop
adjustable>adjust defensible>defens irritant>irrit replacement>replac
dependent>depend homologous>homolog communism>commun activate>activ
angularity>angular effective>effect bowdlerize>bowdler archaeology>archaeolog
yes>ye by>by say>sai any>ani eyed>ei eyes>ey dyed>dy lied>li aged>ag y>y ay>ay
""".split())

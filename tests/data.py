"""Small inputs with known answers."""

DEMO = ["a c d f", "a b c f", "b f o", "b s p", "a c e f p"]

DEMO_ITEMSETS = {
    ("a",): 3,
    ("b",): 3,
    ("c",): 3,
    ("f",): 4,
    ("p",): 2,
    ("a", "c"): 3,
    ("a", "f"): 3,
    ("b", "f"): 2,
    ("c", "f"): 3,
    ("a", "c", "f"): 3,
}

# antecedent, consequent, antecedent support, consequent support, support, confidence
DEMO_RULES = [
    (("a",), "c", 0.6, 0.6, 0.6, 1.0),
    (("c",), "a", 0.6, 0.6, 0.6, 1.0),
    (("a",), "f", 0.6, 0.8, 0.6, 1.0),
    (("f",), "a", 0.8, 0.6, 0.6, 0.75),
    (("c",), "f", 0.6, 0.8, 0.6, 1.0),
    (("f",), "c", 0.8, 0.6, 0.6, 0.75),
    (("b",), "f", 0.6, 0.8, 0.4, 0.666667),
    (("f",), "b", 0.8, 0.6, 0.4, 0.5),
    (("a", "c"), "f", 0.6, 0.8, 0.6, 1.0),
    (("a", "f"), "c", 0.6, 0.6, 0.6, 1.0),
    (("c", "f"), "a", 0.6, 0.6, 0.6, 1.0),
]

LETTERS = [
    "a,c,d,f,g,i,m,p",
    "a,b,c,f,i,m,o",
    "b,f,h,j,o",
    "b,c,k,s,p",
    "a,c,e,f,l,m,n,p",
]

LETTERS_2 = [
    "a,b,c,e,f,o",
    "a,c,g",
    "e,i",
    "a,c,d,e,g",
    "a,c,e,g,l",
    "e,j",
    "a,b,c,e,f,p",
    "a,c,d",
    "a,c,e,g,m",
    "a,c,e,g,n",
]

# input, min_support, itemsets by size
LETTER_SIZES = [
    (LETTERS, 2, {1: 8, 2: 18, 3: 17, 4: 9, 5: 2}),
    (LETTERS, 3, {1: 6, 2: 7, 3: 4, 4: 1}),
    (LETTERS_2, 2, {1: 7, 2: 15, 3: 14, 4: 6, 5: 1}),
    (LETTERS_2, 3, {1: 4, 2: 6, 3: 4, 4: 1}),
]

#: null, empty, blank, signs only, one word, and a very long text
ODD = [None, "", "   \n", "*** !!!", "word", "lang text score " * 4000]

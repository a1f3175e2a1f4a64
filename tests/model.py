"""Plain-Python model of assembly, written from the rules, to compare Spark against."""


def assemble(lines, terminator, glue):
    """Events as (index of the closing line, body), and the indexes of the lines left over."""
    events, left = [], []
    for index, line in enumerate(lines):
        left.append((index, line))
        if line.endswith(terminator):
            texts = [text for _, text in left]
            if events and "" in texts:
                texts.remove("")
            events.append((index, glue.join(texts)))
            left = []
    return events, [index for index, _ in left]

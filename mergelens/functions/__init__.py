"""Column builders: text helpers, the rule table, scoring, stemming."""

"""Parameters of the registered dashboard queries, for the queries and their oracle SQL."""

YEARS = (1996, 2000)
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE"]
M_SCALE = 300  # with this scale and F_CUTS, the source data has customers of every score
F_CUTS = [(5, 18), (4, 14), (3, 10), (2, 4)]
CATEGORIES = ["ECONOMY", "PROMO", "SMALL"]
#: Rendered questions: each conversation turn's text goes with one of these, by its number.
QUESTIONS = ["Sales by region?", "monthly profit trend", "Who are the TOP customers", "best products, please", "revenue of all regions",
             "stop customers", "top-customers", "the historyprofit", "highest product", "sales", "month: sales and region sales", "best clients_"]

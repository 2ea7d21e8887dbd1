"""Fixed reference values.

FIXED VALUES -- these lists must stay exactly as given (they are data, not
rules): New York City public-school calendar intervals (first and last day,
both inclusive, month/day/year), Super Bowl dates and Easter Sunday dates.
Kept as plain text in their natural order; parsed by the helpers below.
"""

from __future__ import annotations

# FIXED VALUES: school calendar, "kind first_day last_day" (inclusive).
SCHOOL_CALENDAR = """
schoolYear 09/08/2005 06/28/2006
schoolYear 09/05/2006 06/27/2007
schoolYear 09/04/2007 06/26/2008
schoolYear 09/02/2008 06/26/2009
schoolYear 09/09/2009 06/28/2010
schoolYear 09/08/2010 06/28/2011
schoolYear 09/08/2011 06/27/2012
schoolYear 09/06/2012 06/26/2013
schoolYear 09/10/2013 06/26/2014
schoolYear 09/04/2014 06/26/2015
schoolYear 09/09/2015 06/28/2016
schoolYear 09/08/2016 06/28/2017
schoolYear 09/07/2017 06/26/2018
schoolYear 09/05/2018 06/26/2019
schoolYear 09/05/2019 06/26/2020
schoolYear 09/21/2020 06/25/2021
schoolYear 09/13/2021 06/27/2022
schoolYear 09/08/2022 06/27/2023
schoolYear 09/07/2023 06/26/2024
schoolYear 09/05/2024 06/26/2025
thanksgivingBreak 11/24/2005 11/25/2005
thanksgivingBreak 11/23/2006 11/24/2006
thanksgivingBreak 11/22/2007 11/23/2007
thanksgivingBreak 11/27/2008 11/28/2008
thanksgivingBreak 11/26/2009 11/27/2009
thanksgivingBreak 11/25/2010 11/26/2010
thanksgivingBreak 11/24/2011 11/25/2011
thanksgivingBreak 11/22/2012 11/23/2012
thanksgivingBreak 11/28/2013 11/29/2013
thanksgivingBreak 11/27/2014 11/28/2014
thanksgivingBreak 11/26/2015 11/27/2015
thanksgivingBreak 11/24/2016 11/25/2016
thanksgivingBreak 11/23/2017 11/24/2017
thanksgivingBreak 11/22/2018 11/23/2018
thanksgivingBreak 11/28/2019 11/29/2019
thanksgivingBreak 11/26/2020 11/27/2020
thanksgivingBreak 11/25/2021 11/26/2021
thanksgivingBreak 11/24/2022 11/25/2022
thanksgivingBreak 11/23/2023 11/24/2023
thanksgivingBreak 11/28/2024 11/29/2024
winterBreak 12/26/2005 01/02/2006
winterBreak 12/25/2006 01/01/2007
winterBreak 12/24/2007 01/01/2008
winterBreak 12/24/2008 01/04/2009
winterBreak 12/24/2009 01/03/2010
winterBreak 12/24/2010 01/02/2011
winterBreak 12/25/2011 01/02/2012
winterBreak 12/24/2012 01/01/2013
winterBreak 12/24/2013 01/01/2014
winterBreak 12/24/2014 01/04/2015
winterBreak 12/24/2015 01/01/2016
winterBreak 12/26/2016 01/02/2017
winterBreak 12/25/2017 01/01/2018
winterBreak 12/24/2018 01/01/2019
winterBreak 12/23/2019 01/01/2020
winterBreak 12/24/2020 01/01/2021
winterBreak 12/24/2021 12/31/2021
winterBreak 12/26/2022 01/02/2023
winterBreak 12/25/2023 01/01/2024
winterBreak 12/23/2024 01/01/2025
midWinterBreak 02/20/2006 02/24/2006
midWinterBreak 02/19/2007 02/23/2007
midWinterBreak 02/18/2008 02/22/2008
midWinterBreak 02/16/2009 02/20/2009
midWinterBreak 02/15/2010 02/19/2010
midWinterBreak 02/21/2011 02/25/2011
midWinterBreak 02/20/2012 02/24/2012
midWinterBreak 02/18/2013 02/22/2013
midWinterBreak 02/17/2014 02/21/2014
midWinterBreak 02/16/2015 02/22/2015
midWinterBreak 02/15/2016 02/19/2016
midWinterBreak 02/20/2017 02/24/2017
midWinterBreak 02/16/2018 02/23/2018
midWinterBreak 02/18/2019 02/22/2019
midWinterBreak 02/17/2020 02/21/2020
midWinterBreak 02/15/2021 02/19/2021
midWinterBreak 02/21/2022 02/25/2022
midWinterBreak 02/20/2023 02/24/2023
midWinterBreak 02/19/2024 02/23/2024
midWinterBreak 02/17/2025 02/21/2025
springBreak 04/13/2006 04/21/2006
springBreak 04/02/2007 04/10/2007
springBreak 04/21/2008 04/24/2008
springBreak 04/09/2009 04/19/2009
springBreak 03/29/2010 04/05/2010
springBreak 04/18/2011 04/25/2011
springBreak 04/06/2012 04/15/2012
springBreak 03/24/2013 04/02/2013
springBreak 04/14/2014 04/21/2014
springBreak 04/03/2015 04/12/2015
springBreak 04/25/2016 04/30/2016
springBreak 04/10/2017 04/17/2017
springBreak 03/30/2018 04/05/2018
springBreak 04/19/2019 04/26/2019
springBreak 04/09/2020 04/19/2020
springBreak 03/29/2021 04/01/2021
springBreak 04/15/2022 04/21/2022
springBreak 04/10/2023 04/14/2023
springBreak 04/22/2024 04/30/2024
springBreak 04/14/2025 04/18/2025
"""

# FIXED VALUES: Super Bowl dates, yyyy-mm-dd.
SUPER_BOWL_DATES = """
2005-02-06 2006-02-05 2007-02-04 2008-02-03 2009-02-01 2010-02-07 2011-02-06
2012-02-05 2013-02-03 2014-02-02 2015-02-01 2016-02-07 2017-02-05 2018-02-04
2019-02-03 2020-02-02 2021-02-07 2022-02-13 2023-02-12 2024-02-11 2025-02-09
"""

# FIXED VALUES: Easter Sunday dates, yyyy-mm-dd (the Easter flag itself is
# computed by rule; this list is its golden check).
EASTER_DATES = """
2005-03-27 2006-04-16 2007-04-08 2008-03-23 2009-04-12 2010-04-04 2011-04-24
2012-04-08 2013-03-31 2014-04-20 2015-04-05 2016-03-27 2017-04-16 2018-04-01
2019-04-21 2020-04-12 2021-04-04 2022-04-17 2023-04-09 2024-03-31 2025-04-20
"""

# Interval kinds in the order their flag columns are added.
BREAK_KINDS = ("schoolYear", "winterBreak", "midWinterBreak", "springBreak", "thanksgivingBreak")


def school_intervals() -> list[tuple[str, str, str]]:
    """[(kind, first 'MM/dd/yyyy', last 'MM/dd/yyyy')]."""
    return [tuple(line.split()) for line in SCHOOL_CALENDAR.strip().splitlines()]


def date_list(text: str) -> list[str]:
    return text.split()

"""The data marts of a legislature: members, caucuses, events, votes, expenses, inquiries.

``schemas`` declares the landed records, ``silver`` the dimensions, bridges
and facts, ``gold`` the marts, ``build`` the order they depend on.
"""

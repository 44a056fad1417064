"""Names, labels and texts that must appear exactly as written in results."""

NIL_GUID = "00000000-0000-0000-0000-000000000000"

# Donor status tiers, most recent giver first.
CURRENT_DONOR = "Current Donor"
LAPSING = "Lapsing"
LAPSED = "Lapsed"
FORMER_DONOR = "Former Donor"
NEVER_DONATED = "Never Donated"

# Text around the peer average; the missing space after the number is part of the value.
TOP_AVERAGE_PREFIX = "Last year, our top contributors gave on average "
TOP_AVERAGE_SUFFIX = (
    "Please consider a gift that is comfortable for your family and know that it is deeply "
    "appreciated and spent wisely. Any amount benefits our school tremendously, but to help you "
    "get started, here are some suggested amounts:"
)

DONATION_FORM_PATH = "/forms/donation/"
LINK_OPEN = '<a href="'
LINK_CLOSE = '" target="_blank">Donate Here</a>'

# Words used in the names of the fiscal-year columns, by number of years back.
YEARS_BACK = {
    1: "One",
    2: "Two",
    3: "Three",
    4: "Four",
    5: "Five",
    6: "Six",
    7: "Seven",
    8: "Eight",
    9: "Nine",
}

ALL_DONOR_AVERAGE = "Average Donation All Donors Previous FY"
TOP_DONOR_AVERAGE = "Average Donation Top Donors Previous FY"

# Output columns that a later step fills in; emitted as ''.
EMPTY_TEXT_COLUMNS = (
    "SmartTextForRoles",
    "AllSmartRoles",
    "DonorRoles",
    "DonorSubRoles",
    "FirstNamesOfEnrolledWards",
    "FirstNamesOfAlumniGrandchildren",
    "RFM",
    "ConsecutiveYearsGivenForDisplay",
    "LifetimeDonatedAmountFormatted",
    "AverageDonationAmountFormatted",
    "FirstDonationAmountFormatted",
    "LastDonationAmountFormatted",
    "LargestDonationAmountFormatted",
    "FormattedDateString",
    "AverageDonationAllSchoolPreviousFY",
    "AverageDonationTopPercentilePreviousFY",
    "RecommendedAskStringWithThreeValues",
    "RecommendedAskStringWithThreeValuesAndLinks",
    "RecommendedAskStringWithFourValues",
    "RecommendedAskStringWithFourValuesAndLinks",
    "RecommendedAskStringWithFiveValues",
    "RecommendedAskStringWithFiveValuesAndLinks",
    "RecommendedAskStringFromTemplateGivingLevels",
    "RecommendedAskStringFromTemplateGivingLevelsWithLinks",
    "RecommendedAskStringFromTemplateGivingLevelsWithTitles",
    "RecommendedAskStringFromTemplateGivingLevelsWithTitlesAndLinks",
    "SuggestedAskLowestCalculatedAmount",
    "SuggestedAskMiddleCalculatedAmount",
    "SuggestedAskHighestCalculatedAmount",
    "SuggestedAskFromAverageContribution",
    "SuggestedAskFromLatestContribution",
    "SuggestedAskFromLargestContribution",
    "SuggestedAskAmountForThoseWithoutDonationHistory",
)
# The same, emitted as 0.
ZERO_COLUMNS = ("ConsecutiveYearsGiven",)

# The export's columns in output order.
EXPORT_COLUMNS = (
    "DonorProfileID",
    "SchoolName",
    "SchoolAddress",
    "SchoolPhone",
    "SchoolEmailAddress",
    "ActualGivingName",
    "ActualGreeting",
    "ActualAddressSalutation",
    "FamilySalutation",
    "RecipientAddress",
    "Address1",
    "Address2",
    "City",
    "Region",
    "PostalCode",
    "CountryCode",
    "ActualEmailAddressTitle",
    "ActualPhoneNumberTitle",
    "IsDonorAdvisedFund",
    "SmartTextForRoles",
    "AllSmartRoles",
    "DonorRoles",
    "DonorSubRoles",
    "FirstNamesOfEnrolledWards",
    "FirstNamesOfAlumniGrandchildren",
    "RFM",
    "DonorStatus",
    "TotalYearsGiven",
    "ConsecutiveYearsGiven",
    "ConsecutiveYearsGivenForDisplay",
    "NumberOfGiftsAndPledgesLifetime",
    "NumberOfStockDonationsLifetime",
    "NumberOfInKindDonationsLifetime",
    "LifetimeDonatedAmount",
    "LifetimeDonatedAmountFormatted",
    "AverageDonationAmount",
    "AverageDonationAmountFormatted",
    "FirstDonationDate",
    "FirstDonationAmount",
    "FirstDonationAmountFormatted",
    "LastDonationAmount",
    "LastDonationAmountFormatted",
    "LastDonationDate",
    "LargestDonationAmount",
    "LargestDonationAmountFormatted",
    "LargestDonationDate",
    "DonatedPreviousThreeYears",
    "FiscalYearToDate",
    "NumberOfGiftsAndPledgesYearToDate",
    "NumberOfStockDonationsYearToDate",
    "NumberOfInKindDonationsYearToDate",
    "DonatedYearToDate",
    "DonatedYearToDateFormatted",
    "PercentChangeFromLastFiscalYear",
    "FiscalLastYear",
    "NumberOfGiftsAndPledgesLastFiscalYear",
    "NumberOfStockDonationsLastFiscalYear",
    "NumberOfInKindDonationsLastFiscalYear",
    "DonatedLastYear",
    "DonatedLastYearFormatted",
    "PercentChangeFromTwoFYAgoToOneFYAgo",
    "FiscalTwoYearsAgo",
    "DonatedTwoYearsAgo",
    "DonatedTwoYearsAgoFormatted",
    "PercentChangeFromThreeFYAgoToTwoFYAgo",
    "FiscalThreeYearsAgo",
    "DonatedThreeYearsAgo",
    "DonatedThreeYearsAgoFormatted",
    "PercentChangeFromFourFYAgoToThreeFYAgo",
    "FiscalFourYearsAgo",
    "DonatedFourYearsAgo",
    "DonatedFourYearsAgoFormatted",
    "PercentChangeFromFiveFYAgoToFourFYAgo",
    "FiscalFiveYearsAgo",
    "DonatedFiveYearsAgo",
    "DonatedFiveYearsAgoFormatted",
    "PercentChangeFromSixFYAgoToFiveFYAgo",
    "FiscalSixYearsAgo",
    "DonatedSixYearsAgo",
    "DonatedSixYearsAgoFormatted",
    "PercentChangeFromSevenFYAgoToSixFYAgo",
    "FiscalSevenYearsAgo",
    "DonatedSevenYearsAgo",
    "DonatedSevenYearsAgoFormatted",
    "PercentChangeFromEightFYAgoToSevenFYAgo",
    "FiscalEightYearsAgo",
    "DonatedEightYearsAgo",
    "DonatedEightYearsAgoFormatted",
    "PercentChangeFromNineFYAgoToEightFYAgo",
    "FiscalNineYearsAgo",
    "DonatedNineYearsAgo",
    "DonatedNineYearsAgoFormatted",
    "FormattedDateString",
    "DonationCampaignTitle",
    "DonationCampaignGoalFromTemplate",
    "DonationCampaignRaisedFromTemplate",
    "DonationCampaignRemainingFromTemplate",
    "DonationCampaignPercentToGoalFromTemplate",
    "AverageDonationAllSchoolPreviousFY",
    "AverageDonationTopPercentilePreviousFY",
    "RecommendedAskStringWithThreeValues",
    "RecommendedAskStringWithThreeValuesAndLinks",
    "RecommendedAskStringWithFourValues",
    "RecommendedAskStringWithFourValuesAndLinks",
    "RecommendedAskStringWithFiveValues",
    "RecommendedAskStringWithFiveValuesAndLinks",
    "RecommendedAskStringFromTemplateGivingLevels",
    "RecommendedAskStringFromTemplateGivingLevelsWithLinks",
    "RecommendedAskStringFromTemplateGivingLevelsWithTitles",
    "RecommendedAskStringFromTemplateGivingLevelsWithTitlesAndLinks",
    "LinkToDonationForm",
    "UrlToDonationForm",
    ALL_DONOR_AVERAGE,
    TOP_DONOR_AVERAGE,
    "CurrentDate",
    "Campaigns",
    "Funds",
    "Appeals",
    "Notes",
    "SuggestedAskLowestCalculatedAmount",
    "SuggestedAskMiddleCalculatedAmount",
    "SuggestedAskHighestCalculatedAmount",
    "SuggestedAskFromAverageContribution",
    "SuggestedAskFromLatestContribution",
    "SuggestedAskFromLargestContribution",
    "SuggestedAskAmountForThoseWithoutDonationHistory",
)
